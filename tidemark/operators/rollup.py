"""Sales rows that add up over any period: sums, and distinct orders as mergeable bitmaps.

Orders get dense numbers. A sale key's orders are kept as rows of a chunk of 32,768 numbers each,
so that no row grows with the data: as a bitmap for days, as a list of positions for timestamps,
which have few orders each. Bitmaps of a chunk are joined by OR, so a week's or month's distinct
orders are exact and come from the days' rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sales import KEY_NAME, completed, finish, order_sums

CHUNK = "chunk"
ORDERS = "orders"
POSITIONS = "positions"
_SUMS = ("pieces", "revenue_c", "cost_c")


def _added() -> list[Column]:
    return [F.sum(c).alias(c) for c in _SUMS]


def numbered_sales(
    items: DataFrame, orders: DataFrame, numbers: DataFrame, grain: str, ts_column: str = "kafka_ts"
) -> DataFrame:
    """Sums per Completed order and sale key, with the order's number (``order_no``)."""
    sold = order_sums(items, grain, ts_column).join(
        completed(orders).select("order_id"), "order_id", "left_semi")
    return sold.join(numbers.select("order_id", "order_no"), "order_id")


def bitmap_rows(sold: DataFrame, key: str) -> DataFrame:
    """One row per key and chunk: sums, and the chunk's orders as a bitmap.

    Rows meet before bitmaps are made of them. Each task would else make one of 4 KB for every
    key and chunk it has a row of, and rows dealt out by order have nearly all of them.
    """
    placed = sold.select(
        key, F.bitmap_bucket_number("order_no").alias(CHUNK),
        F.bitmap_bit_position("order_no").alias("position"), *_SUMS)
    parts = int(sold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, key, CHUNK).groupBy(key, CHUNK).agg(
        F.bitmap_construct_agg("position").alias(ORDERS), *_added())


def position_rows(sold: DataFrame, key: str) -> DataFrame:
    """One row per key and chunk: sums, and the chunk's orders as a list of positions."""
    return sold.groupBy(key, F.bitmap_bucket_number("order_no").alias(CHUNK)).agg(
        F.collect_set(F.bitmap_bit_position("order_no").cast("int")).alias(POSITIONS), *_added())


def roll_up_bitmaps(rows: DataFrame, period: Column, name: str) -> DataFrame:
    """Metrics per period from the rows of shorter ones.

    The rows of a chunk and period are joined first, then the chunks' counts are added up.
    """
    joined = rows.groupBy(period.alias(name), CHUNK).agg(
        F.bitmap_or_agg(ORDERS).alias(ORDERS), *_added())
    totals = joined.groupBy(name).agg(
        F.sum(F.bitmap_count(ORDERS)).alias("total_orders"),
        F.sum("pieces").alias("total_items_sold"), F.sum("revenue_c").alias("revenue_c"),
        F.sum("cost_c").alias("cost_c"))
    return finish(totals, name)


def roll_up_positions(rows: DataFrame, period: Column, name: str) -> DataFrame:
    """Metrics per period from the rows of timestamps.

    Sums are added up before the positions are laid out, so that no sum counts twice.
    """
    keyed = rows.select(period.alias(name), CHUNK, POSITIONS, *_SUMS)
    sums = keyed.groupBy(name).agg(*_added())
    chunks = keyed.select(name, CHUNK, F.explode(POSITIONS).alias("position")).groupBy(
        name, CHUNK).agg(F.bitmap_construct_agg("position").alias(ORDERS))
    counts = chunks.groupBy(name).agg(F.sum(F.bitmap_count(ORDERS)).alias("total_orders"))
    return finish(
        sums.withColumnRenamed("pieces", "total_items_sold").join(counts, name), name)


def sale_period(unit: str, grain: str) -> Column:
    """The first day of the period that a row's sale key lies in."""
    return F.to_date(F.date_trunc(unit, KEY_NAME[grain]))
