"""Stored tables on parquet: sorted appends, partition replacement, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.temporal import month_key
from tidemark.schemas import ShopTable
from tidemark.session import let_go

CODEC = "zstd"
MONTH = "sale_month"
CREATED_MONTH = "created_month"
BUCKET = "bucket"


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` finished."""
    return exists(spark, f"{path}/_SUCCESS")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table, or no rows where it has never been written."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def with_bucket(rows: DataFrame, key: str | list[str], buckets: int) -> DataFrame:
    columns = [key] if isinstance(key, str) else key
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))


def spread(rows: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of a partition value together in few, even files.

    The adaptive planner merges small groups and splits one that is too large, so a
    month or bucket with a third of all rows is still written by many tasks.
    """
    return rows.hint("rebalance", *columns)


def values_of(rows: DataFrame, column: str) -> list:
    """The distinct values of a partition column (months, buckets), for pruning a scan.

    Only for columns whose number of values is fixed by the layout, not by the data.
    """
    return [r[0] for r in rows.where(F.col(column).isNotNull()).select(column).distinct().collect()]


def overwrite(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace the whole table."""
    rows.write.mode("overwrite").option("compression", CODEC).partitionBy(*partitions).parquet(path)
    let_go(rows.sparkSession)


def overwrite_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace only the partitions that ``rows`` has rows for."""
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC).partitionBy(*partitions).parquet(path)
    )
    let_go(rows.sparkSession)


def stored_columns(rows: DataFrame, table: ShopTable) -> DataFrame:
    """The storage columns of a table, with the arrival time filled in.

    Tables with a creation date get a month column to partition by.
    """
    arrival = F.current_timestamp()
    if "kafka_ts" in rows.columns:
        arrival = F.coalesce(F.col("kafka_ts"), arrival)
    rows = rows.select(*table.columns, arrival.alias("kafka_ts"))
    if table.month_of:
        rows = rows.withColumn(CREATED_MONTH, month_key(F.col(table.month_of)))
    return rows


def month_partitions(table: ShopTable) -> list[str]:
    return [CREATED_MONTH] if table.month_of else []


def in_storage_order(rows: DataFrame, table: ShopTable) -> DataFrame:
    """Sort within the write tasks, so that readers skip row groups by their statistics."""
    return rows.sortWithinPartitions(*month_partitions(table), *map(F.expr, table.sort))


def fixed_buckets(
    spark: SparkSession, path: str, wanted: int | None = None, default: int = 64
) -> int:
    """The number of hash buckets of a table, stored at ``path`` when it is first asked for.

    A key's bucket depends on the number, so another one later would look for rows, and put
    them, where they are not: it is refused.
    """
    if not is_complete(spark, path):
        count = spark.range(1).select(F.lit(wanted or default).alias("buckets"))
        overwrite(count, path)
    held = spark.read.schema("buckets int").parquet(path).first()["buckets"]
    if wanted not in (None, held):
        raise ValueError(f"{path}: the table has {held} buckets, not {wanted}")
    return held


def append_sorted(rows: DataFrame, path: str, table: ShopTable) -> None:
    """Append to a stored table in its sort order.

    Rows of many months are first brought together by month; otherwise every task
    would write a small file into each of them.
    """
    partitions = month_partitions(table)
    rows = stored_columns(rows, table)
    if partitions:
        rows = spread(rows, *partitions)
    (
        in_storage_order(rows, table).write.mode("append").option("compression", CODEC)
        .partitionBy(*partitions).parquet(path)
    )


def with_month(rows: DataFrame, day: str) -> DataFrame:
    return rows.withColumn(MONTH, month_key(F.col(day)))


def replace_days(
    spark: SparkSession, path: str, fresh: DataFrame, days: DataFrame, key: str, schema: T.StructType
) -> None:
    """Replace the rows of the given days by the fresh ones, month by month.

    ``days`` is a stored table with a ``sale_date`` column. Other days of a touched
    month are carried over. Every given day also gets an empty row (NULL measures):
    a month that received no row at all would keep its old content. ``read_days``
    hides these rows, and the next replacement of the day takes them away.
    """
    days = days.where(F.col("sale_date").isNotNull())
    months = values_of(with_month(days, "sale_date"), MONTH)
    if not months:
        return
    carried = (
        read_or_empty(spark, path, schema).where(F.col(MONTH).isin(months))
        .withColumn("sale_date_", F.to_date(key))
        .join(days.select(F.col("sale_date").alias("sale_date_")), "sale_date_", "left_anti")
        .drop("sale_date_")
    )
    empty = days.select(F.col("sale_date").cast(schema[key].dataType).alias(key))
    rows = with_month(fresh, key).unionByName(carried).unionByName(
        with_month(empty, key), allowMissingColumns=True
    )
    overwrite_partitions(
        spread(rows.select(*schema.fieldNames()), MONTH).sortWithinPartitions(MONTH, key), path, MONTH
    )


def read_days(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The summary rows that have sales."""
    return read_or_empty(spark, path, schema).where(F.col("total_orders") > 0)


def expire_before(spark: SparkSession, path: str, day: str, column: str, month: str = MONTH) -> None:
    """Drop rows older than ``day``: whole months by folder, the cut month by rewrite.

    Only the list of months comes to the driver. Rows without a month are kept: their age
    is not known.
    """
    table = spark.read.parquet(path)
    cut_day = F.lit(day).cast("date")
    cut_month = int(day[:4] + day[5:7])
    kept = table.where((F.col(month) == cut_month) & (F.to_date(column) >= cut_day))
    cut_to_nothing = kept.isEmpty()
    if not cut_to_nothing:
        overwrite_partitions(kept, path, month)
    target, fs = _hadoop_path(spark, path)
    for status in fs.listStatus(target):
        name, _, value = status.getPath().getName().partition("=")
        if name != month or not value.isdigit():
            continue
        if int(value) < cut_month or (int(value) == cut_month and cut_to_nothing):
            fs.delete(status.getPath(), True)


def drop_oldest(spark: SparkSession, path: str, partition: str, keep: int) -> None:
    """Delete the folders of a numbered partition column but for the ``keep`` highest numbers."""
    target, fs = _hadoop_path(spark, path)
    if not fs.exists(target):
        return
    found = {}
    for status in fs.listStatus(target):
        name, _, value = status.getPath().getName().partition("=")
        if name == partition and value.isdigit():
            found[int(value)] = status.getPath()
    for number in sorted(found)[: max(len(found) - keep, 0)]:
        fs.delete(found[number], True)
