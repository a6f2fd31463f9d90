"""Items and orders stored by order, so that they join where they lie.

Both tables are bucketed by the order and sorted by it within a bucket: summing a bucket's items
per order and day and joining its orders moves no row; only the days' sums do. An order that holds
more than one in ``SHARE`` of all items would make one bucket too large. The items of these (at
most ``SHARE``) orders lie in a table of their own, in files of even size; they are summed per order
and day in every task, and their orders, as few, are sent to all tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sales import DAY, KEY_NAME, completed, order_sums, roll_up
from tidemark.sinks.tables import CODEC, overwrite, read_or_empty

#: An order is hot from one in so many of all items; so there are never more hot orders.
SHARE = 1000

#: Items a bucket is to hold: its task sorts them.
BUCKET_ITEMS = 1_000_000


@dataclass(frozen=True)
class ColocatedSales:
    """The folder of the tables, a prefix for their names in the catalog, and their buckets.

    There are at least ``buckets``, and more where one would hold over ``bucket_items`` items.
    """

    root: str
    name: str
    buckets: int
    share: int = SHARE
    bucket_items: int = BUCKET_ITEMS

    def _save(self, rows: DataFrame, table: str, buckets: int) -> None:
        """One file a bucket: the rows are dealt out by the bucket's own hash."""
        (
            rows.repartition(buckets, "order_id").write.format("parquet").mode("overwrite")
            .option("compression", CODEC).option("path", f"{self.root}/{table}")
            .bucketBy(buckets, "order_id").sortBy("order_id")
            .saveAsTable(f"{self.name}_{table}")
        )

    def store(self, spark: SparkSession, items: DataFrame, orders: DataFrame) -> None:
        counts = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        overwrite(counts, f"{self.root}/counts")
        counts = spark.read.schema("order_id string, n long").parquet(f"{self.root}/counts")
        total = counts.agg(F.sum("n")).first()[0] or 0
        overwrite(counts.where(F.col("n") > total / self.share).select("order_id"), f"{self.root}/hot")
        hot = F.broadcast(self.hot_orders(spark))
        buckets = max(self.buckets, -(-total // self.bucket_items))
        self._save(items.join(hot, "order_id", "left_anti"), "items", buckets)
        self._save(orders, "orders", buckets)
        overwrite(items.join(hot, "order_id", "left_semi").hint("rebalance"), f"{self.root}/hot_items")

    def hot_orders(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("order_id string").parquet(f"{self.root}/hot")

    def metrics(self, spark: SparkSession, grain: str = DAY, ts_column: str = "kafka_ts") -> DataFrame:
        items = spark.table(f"{self.name}_items")
        counted = completed(spark.table(f"{self.name}_orders")).select("order_id")
        sold = order_sums(items, grain, ts_column).join(counted, "order_id", "left_semi")
        hot_items = read_or_empty(spark, f"{self.root}/hot_items", items.schema)
        hot = counted.join(F.broadcast(self.hot_orders(spark)), "order_id", "left_semi")
        hot_sold = order_sums(hot_items, grain, ts_column).join(
            F.broadcast(hot), "order_id", "left_semi")
        return roll_up(sold.unionByName(hot_sold), KEY_NAME[grain])
