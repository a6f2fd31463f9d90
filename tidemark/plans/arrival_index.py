"""An index over stored changes: which days a changed item or order can be found on.

The stored tables keep every version of every row and only grow. Beside them lie, by hash bucket
of the key or by sale month:

    versions/     item, order and arrival of every item version, by bucket of the item
    order_days/   the days an order has item versions on, by bucket of the order
    statuses/     the latest version of every order, by bucket of the order
    superseded/   item versions that a later one has replaced, by their month
    dead/         what the last run has found to enter there

A run looks its new rows' keys up in the buckets they fall into and rewrites these buckets only,
sorted by key. An item version counts if no entry of its own month says otherwise, so that a
month's current items are found by reading that month. Every step may be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import month_key
from tidemark.operators.changes import latest_per_key
from tidemark.session import at_once
from tidemark.sinks.tables import (
    BUCKET,
    MONTH,
    fixed_buckets,
    is_complete,
    overwrite,
    overwrite_partitions,
    read_or_empty,
    spread,
    values_of,
    with_bucket,
    with_month,
)

#: The partition column of stored tables that runs prune by.
ARRIVAL_MONTH = "arrival_month"
#: Orders the versions of one key in the stored tables.
ARRIVAL = ("kafka_ts", "offset")

_ARRIVED = "kafka_ts timestamp, offset long"
_SCHEMAS = {
    "versions": f"order_item_id string, order_id string, {_ARRIVED}, {BUCKET} int",
    "order_days": f"order_id string, sale_date date, {BUCKET} int",
    "statuses": f"order_id string, op string, status string, {_ARRIVED}, {BUCKET} int",
    "superseded": f"order_item_id string, {_ARRIVED}, {MONTH} int",
}


def by_arrival(rows: DataFrame) -> DataFrame:
    """The rows with the column that stored tables are partitioned by."""
    return rows.withColumn(ARRIVAL_MONTH, month_key(F.col("kafka_ts")))


def arrived_since(rows: DataFrame, since: int) -> DataFrame:
    """Rows from an arrival (microseconds of the epoch) on; whole earlier months are not read."""
    at = F.timestamp_micros(F.lit(since))
    found = rows.where(F.col("kafka_ts") >= at)
    if ARRIVAL_MONTH in rows.columns:
        found = found.where(F.col(ARRIVAL_MONTH) >= month_key(at))
    return found


@dataclass(frozen=True)
class ArrivalIndex:
    """The folder of an index and the number of its hash buckets, fixed when it is built."""

    root: str
    buckets: int | None = None

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        schema = T.StructType.fromDDL(_SCHEMAS[name])
        return read_or_empty(spark, self._path(name), schema)

    def is_built(self, spark: SparkSession) -> bool:
        return is_complete(spark, self._path("built"))

    def close_build(self, spark: SparkSession) -> None:
        if not self.is_built(spark):
            overwrite(spark.range(1), self._path("built"))

    def _replace(self, spark: SparkSession, name: str, rows: DataFrame, key: str) -> None:
        """Write the content of the buckets (or months) that ``rows`` has."""
        layout = MONTH if name == "superseded" else BUCKET
        rows = rows.select(*T.StructType.fromDDL(_SCHEMAS[name]).fieldNames())
        # Rows of buckets come from an aggregate by their key, which has spread them evenly.
        rows = spread(rows, layout) if layout == MONTH else rows
        overwrite_partitions(rows.sortWithinPartitions(layout, key), self._path(name), layout)

    def _held(self, spark: SparkSession, name: str, layout: str, values: list) -> DataFrame:
        return self.read(spark, name).where(F.col(layout).isin(values))

    def take_in(self, spark: SparkSession, items: DataFrame, orders: DataFrame) -> None:
        """Add rows that have arrived."""
        count = fixed_buckets(spark, self._path("count"), self.buckets)

        def versions() -> None:
            new = with_bucket(
                items.select("order_item_id", "order_id", *ARRIVAL), "order_item_id", count)
            touched = self._add(spark, "versions", new, "order_item_id")
            if touched:
                self._supersede(spark, new.select("order_item_id"), touched)

        def order_days() -> None:
            pairs = items.where("order_id IS NOT NULL").select(
                "order_id", F.to_date("kafka_ts").alias("sale_date"))
            self._add(spark, "order_days", with_bucket(pairs, "order_id", count), "order_id")

        def statuses() -> None:
            rows = orders.select("order_id", "op", "status", *ARRIVAL)
            self._add(spark, "statuses", with_bucket(rows, "order_id", count), "order_id")

        at_once(versions, order_days, statuses)

    def _add(self, spark: SparkSession, name: str, new: DataFrame, key: str) -> list[int]:
        """Merge rows into the buckets they fall into, moving them once; these buckets."""
        touched = values_of(new, BUCKET)
        if touched:
            every = self._held(spark, name, BUCKET, touched).unionByName(new)
            every = latest_per_key(every, [key], ARRIVAL) if name == "statuses" else every.distinct()
            self._replace(spark, name, every, key)
        return touched

    def _supersede(self, spark: SparkSession, changed: DataFrame, touched: list) -> None:
        """Enter all versions of the changed items but the latest in their months."""
        every = self._held(spark, "versions", BUCKET, touched).join(
            changed, "order_item_id", "left_semi")
        latest = F.max(F.struct(*ARRIVAL)).over(Window.partitionBy("order_item_id"))
        every = every.select("order_item_id", *ARRIVAL, latest.alias("latest"))
        is_latest = F.lit(True)
        for name in ARRIVAL:
            is_latest = is_latest & (F.col(name) == F.col(f"latest.{name}"))
        dead = every.where(~F.coalesce(is_latest, F.lit(False))).drop("latest")
        overwrite(with_month(dead, "kafka_ts"), self._path("dead"))
        dead = spark.read.schema(_SCHEMAS["superseded"]).parquet(self._path("dead"))
        months = values_of(dead, MONTH)
        if months:
            held = self._held(spark, "superseded", MONTH, months)
            self._replace(spark, "superseded", held.unionByName(dead).distinct(), "order_item_id")

    def days_of(self, spark: SparkSession, items: DataFrame, orders: DataFrame) -> DataFrame:
        """Days of all versions of these items, and of all items of these orders."""
        count = fixed_buckets(spark, self._path("count"), self.buckets)
        found = []
        for name, key, rows in (
            ("versions", "order_item_id", items), ("order_days", "order_id", orders)
        ):
            keys = rows.select(key)
            held = self._held(spark, name, BUCKET, values_of(with_bucket(keys, key, count), BUCKET))
            day = F.to_date("kafka_ts").alias("sale_date") if name == "versions" else "sale_date"
            found.append(held.join(keys.distinct(), key, "left_semi").select(day))
        return found[0].unionByName(found[1]).distinct()

    def live_items(self, spark: SparkSession, items: DataFrame, days: DataFrame) -> DataFrame:
        """The items that are current and arrived on these days; only their months are read.

        ``days`` is a stored table with a ``sale_date`` column. Rows and entries of replaced versions
        meet in one aggregate by key, so that an item is moved once: of its versions read here the
        last one counts, unless it was replaced by one that arrived elsewhere. A version that was
        stored twice counts once.
        """
        months = values_of(with_month(days, "sale_date"), MONTH)
        if ARRIVAL_MONTH in items.columns:
            items = items.where(F.col(ARRIVAL_MONTH).isin(months)).drop(ARRIVAL_MONTH)
        first, last = days.agg(F.min("sale_date"), F.max("sale_date")).first()
        rows = items.where(
            (F.col("kafka_ts") >= F.lit(first).cast("timestamp"))
            & (F.col("kafka_ts") < F.date_add(F.lit(last), 1).cast("timestamp"))
        ).withColumn("sale_date", F.to_date("kafka_ts")).join(days, "sale_date", "left_semi").drop("sale_date")
        key = "order_item_id"
        payload = [c for c in rows.columns if c not in (key, *ARRIVAL)]
        dead = self._held(spark, "superseded", MONTH, months).where("offset IS NOT NULL")
        both = rows.select(
            key, F.struct(*payload).alias("row"), F.struct(*ARRIVAL).alias("version")).unionByName(
            dead.select(key, F.struct(*ARRIVAL).alias("dead")), allowMissingColumns=True)
        last = both.groupBy(key).agg(
            F.max_by("row", "version").alias("row"), F.max("version").alias("version"),
            F.max("dead").alias("dead"))
        last = last.where("dead IS NULL OR version > dead").select(key, "row.*", "version.*")
        return last.where("op <> 'd'")

    def live_orders(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "statuses").where("op <> 'd'")
