"""Change rows to tables: flatten the new image, keep the latest version, drop deletes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import from_iso
from tidemark.schemas import ShopTable

# Orders the versions of one key: event time first, feed position for equal times.
VERSION = ("event_ts", "offset")


def flatten(changes: DataFrame, table: ShopTable) -> DataFrame:
    """The new image as typed columns, plus op, event_ts and offset.

    The key comes from the record key where there is no image, so that a delete
    still says which row it removes.
    """

    def column(field: T.StructField):
        value = F.col("row_key" if field.name == table.key else f"after.{field.name}")
        if isinstance(field.dataType, T.TimestampType):
            value = from_iso(value)
        return value.alias(field.name)

    return changes.select("op", *map(column, table.schema), "event_ts", "offset")


def readable(rows: DataFrame, table: ShopTable) -> DataFrame:
    """Flattened rows that say which row changed and how."""
    return rows.where(F.col("op").isNotNull() & F.col(table.key).isNotNull())


def is_unreadable(table: ShopTable) -> Column:
    """Whether a change row is to be set aside: no op, no key, or timestamp text that is none.

    Records with a broken text or a value that does not fit its column have no op.
    """
    bad = F.col("op").isNull() | F.col("row_key").isNull()
    for field in table.schema:
        if isinstance(field.dataType, T.TimestampType):
            text = F.col(f"after.{field.name}")
            bad = bad | (text.isNotNull() & from_iso(text).isNull())
    return bad


def unreadable(changes: DataFrame, table: ShopTable) -> DataFrame:
    """Change rows to set aside."""
    return changes.where(is_unreadable(table))


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION
) -> DataFrame:
    """The row with the highest version of every key.

    An aggregate, not a ranking window: each map task already reduces a key to one
    row, so a key that holds a third of all changes costs no more than any other.
    """
    payload = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*version)).alias("best")
    return rows.groupBy(*keys).agg(best).select(*keys, "best.*")


def current_rows(changes: DataFrame, table: ShopTable) -> DataFrame:
    """The table the changes lead to: latest versions, deleted rows left out."""
    return latest_per_key(changes, [table.key]).where(F.col("op") != "d")
