"""Keyed records to a broker topic (needs the Kafka connector)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.sources.feeds import encode_metrics


def send_metrics(metrics: DataFrame, servers: str) -> None:
    """Upsert metrics rows: the record key is the timestamp, a later record replaces an earlier one."""
    (
        encode_metrics(metrics).write.format("kafka")
        .option("kafka.bootstrap.servers", servers).save()
    )
