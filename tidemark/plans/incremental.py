"""Daily sales kept up to date from the stored change tables.

The stored tables keep every version of every row, stamped with its arrival time.
A run takes what arrived since the last run's mark, finds the days that can have
changed by an index, computes those days anew from the latest versions and replaces
them in the summary. Recomputing whole days keeps distinct order counts exact and
makes a repeated run harmless.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import latest_per_key
from tidemark.operators.sales import MEASURED, sales_metrics
from tidemark.plans.arrival_index import ARRIVAL, ARRIVAL_MONTH, ArrivalIndex, arrived_since
from tidemark.schemas import TOTAL
from tidemark.settings import FIRST_MARK
from tidemark.sinks.tables import MONTH, overwrite, read_days, read_or_empty, replace_days

SUMMARY = T.StructType([
    T.StructField("sale_date", T.DateType()),
    T.StructField("last_processed_ts", T.TimestampType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_items_sold", T.LongType()),
    T.StructField("total_revenue", TOTAL),
    T.StructField("total_cost", TOTAL),
    T.StructField("total_profit", TOTAL),
    T.StructField("average_order_value", TOTAL),
    T.StructField(MONTH, T.IntegerType()),
])


def high_water_mark(summary: DataFrame, first: str = FIRST_MARK) -> DataFrame:
    """The latest arrival the summary covers, or ``first`` while it is empty."""
    mark = F.coalesce(F.max("last_processed_ts"), F.lit(first).cast("timestamp"))
    return summary.agg(mark.alias("last_processed_ts"))


def new_rows_only(items: DataFrame, orders: DataFrame, mark: datetime | str) -> DataFrame:
    """Metrics of the items that arrived after the mark, as one run adds them."""
    fresh = items.where(F.col("kafka_ts") > F.lit(mark).cast("timestamp"))
    return sales_metrics(fresh, orders)


def current(rows: DataFrame, key: str) -> DataFrame:
    return latest_per_key(rows, [key], ARRIVAL).where(F.col("op") != "d")


def run_incremental(
    spark: SparkSession,
    items: DataFrame,
    orders: DataFrame,
    summary_path: str,
    work_path: str,
    first_mark: str = FIRST_MARK,
    buckets: int | None = None,
) -> None:
    """Bring the summary up to date with the stored tables.

    ``items`` and ``orders`` hold all versions with ``op``, ``kafka_ts`` and ``offset``, best
    partitioned by ``arrival_month`` (``by_arrival``). Errors are raised, so that a scheduler sees
    a failed run. While the summary is empty, days that had all their changes before
    ``first_mark`` are left out.

    The first run reads everything once, to build an index beside the summary. From then on a
    run reads the rows that arrived since the mark, the index buckets of their keys, and the
    months of the days that can have changed: the days of every version of a changed item (an
    update may move it) and of the items of a changed order (it may have become or ceased to be
    Completed).
    """
    marks = high_water_mark(read_or_empty(spark, summary_path, SUMMARY), first_mark)
    mark = marks.select(F.unix_micros("last_processed_ts")).first()[0]
    index = ArrivalIndex(f"{summary_path}_index", buckets)
    new = arrived_since(items, mark), arrived_since(orders, mark)
    index.take_in(spark, *(new if index.is_built(spark) else (items, orders)))
    index.close_build(spark)
    overwrite(index.days_of(spark, *new), f"{work_path}/days")
    days = spark.read.schema("sale_date date").parquet(f"{work_path}/days")
    if days.isEmpty():
        return
    # Only what the metrics follow from is moved by its key.
    needed = {"order_item_id", "op", *ARRIVAL, ARRIVAL_MONTH, *MEASURED}
    items = items.select(*(c for c in items.columns if c in needed))
    fresh = sales_metrics(index.live_items(spark, items, days), index.live_orders(spark))
    replace_days(spark, summary_path, fresh, days, "sale_date", SUMMARY)


def summary(spark: SparkSession, summary_path: str) -> DataFrame:
    return read_days(spark, summary_path, SUMMARY)
