"""Stored sales rows that roll up to any period without another look at the items.

    numbers/   a dense number for each order, by load; a number never changes
    days/      bitmap rows by day, by sale month
    stamps/    position rows by timestamp, by sale month

Numbers follow the orders' creation time, so that a day's orders lie in few chunks. New orders are
sorted by range over all tasks, and each task's rows are counted to tell where its numbers begin:
there is no window over all rows. Days are replaced whole, as a day's orders may drop out again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import rollup
from tidemark.operators.sales import DAY, KEY_NAME, TIMESTAMP
from tidemark.sinks.tables import (
    MONTH, is_complete, overwrite, overwrite_partitions, read_or_empty, spread, with_month,
)

_NUMBERS = "order_id string, order_no long, load string"
_SUMS = {"pieces": "long", "revenue_c": "long", "cost_c": "long", MONTH: "int"}
_ROWS = {
    DAY: {KEY_NAME[DAY]: "date", rollup.CHUNK: "long", rollup.ORDERS: "binary", **_SUMS},
    TIMESTAMP: {
        KEY_NAME[TIMESTAMP]: "timestamp", rollup.CHUNK: "long", rollup.POSITIONS: "array<int>", **_SUMS},
}
_FOLDER = {DAY: "days", TIMESTAMP: "stamps"}


@dataclass(frozen=True)
class SalesRollups:
    root: str

    def numbers(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, f"{self.root}/numbers", _NUMBERS)

    def number_orders(self, spark: SparkSession, orders: DataFrame, load: str) -> None:
        """Give numbers to orders that have none; a load that is numbered already stays as it is."""
        path = f"{self.root}/numbers/load={load}"
        if is_complete(spark, path):
            return
        known = self.numbers(spark).where(F.col("load") != load)
        last = known.agg(F.coalesce(F.max("order_no"), F.lit(0).cast("long"))).first()[0]
        fresh = orders.groupBy("order_id").agg(F.min("created_at").alias("created_at")).join(
            known, "order_id", "left_anti")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        placed = fresh.repartitionByRange(parts, "created_at", "order_id").sortWithinPartitions(
            "created_at", "order_id").select("order_id", F.monotonically_increasing_id().alias("place"))
        # Written once: places depend on how the rows were dealt out.
        overwrite(placed, f"{self.root}/placed/{load}")
        placed = spark.read.schema("order_id string, place long").parquet(
            f"{self.root}/placed/{load}").selectExpr(
            "order_id", "shiftright(place, 33) AS part", "place & 8589934591L AS row")
        counts = {r[0]: r[1] for r in placed.groupBy("part").count().collect()}
        starts, at = [], last + 1
        for part in sorted(counts):
            starts.append((part, at))
            at += counts[part]
        begins = spark.createDataFrame(starts, "part long, begins long")
        numbered = placed.join(F.broadcast(begins), "part")
        overwrite(numbered.selectExpr("order_id", "begins + row AS order_no"), path)

    def store(self, spark: SparkSession, items: DataFrame, orders: DataFrame, grain: str) -> None:
        """Replace the months that these items have sales in."""
        key = KEY_NAME[grain]
        sold = rollup.numbered_sales(items, orders, self.numbers(spark), grain)
        make = rollup.bitmap_rows if grain == DAY else rollup.position_rows
        rows = with_month(make(sold, key), key).select(*_ROWS[grain])
        overwrite_partitions(
            spread(rows, MONTH).sortWithinPartitions(MONTH, key),
            f"{self.root}/{_FOLDER[grain]}", MONTH)

    def rows(self, spark: SparkSession, grain: str) -> DataFrame:
        schema = ", ".join(f"{name} {kind}" for name, kind in _ROWS[grain].items())
        return read_or_empty(spark, f"{self.root}/{_FOLDER[grain]}", schema)

    def roll_up(self, spark: SparkSession, grain: str, unit: str, name: str) -> DataFrame:
        """Metrics per ``unit`` (day, week, month, quarter, year) from the stored rows of a grain."""
        up = rollup.roll_up_bitmaps if grain == DAY else rollup.roll_up_positions
        return up(self.rows(spark, grain), rollup.sale_period(unit, grain), name)
