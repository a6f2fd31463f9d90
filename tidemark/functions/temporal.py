"""Timestamps on the wire and the calendar keys of stored tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def from_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp; text that is no timestamp becomes NULL."""
    return F.try_to_timestamp(text)


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def day_text(text: Column) -> Column:
    """The ``yyyy-MM-dd`` prefix of a timestamp kept as text."""
    return F.substring(text, 1, 10)


def month_key(day: Column) -> Column:
    """``yyyyMM`` as an int, so that the same month of two years stays apart."""
    return F.year(day) * F.lit(100) + F.month(day)
