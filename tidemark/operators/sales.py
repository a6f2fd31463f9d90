"""The sales metrics, defined once for the batch, incremental and streaming jobs.

An item counts when its order is Completed. Items are summed per order and day (or
timestamp), so that counting distinct orders becomes counting rows.

The Completed orders are joined in by a semi join after that sum, at every size: an
order with a third of all items leaves every map task as one row per day. How it is
joined is left to Spark, whose optimizer moves the semi join below the sum where it can
broadcast the orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import as_total, average_cents, cents
from tidemark.settings import COMPLETED

DAY = "day"
TIMESTAMP = "timestamp"
KEY_NAME = {DAY: "sale_date", TIMESTAMP: "ts"}

# What the metrics follow from, of an item besides its time.
MEASURED = ("order_id", "quantity", "price", "cost_price")

MEASURES = (
    "total_orders", "total_items_sold", "total_revenue",
    "total_cost", "total_profit", "average_order_value",
)


def sale_key(grain: str, ts_column: str) -> Column:
    ts = F.col(ts_column)
    return (F.to_date(ts) if grain == DAY else ts).alias(KEY_NAME[grain])


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("status") == COMPLETED)


def order_sums(
    items: DataFrame, grain: str = DAY, ts_column: str = "kafka_ts", weight: str | None = None
) -> DataFrame:
    """Items summed per order and sale key, money in cents.

    With a ``weight`` column of +1 and -1 the items are a ledger of added and
    withdrawn contributions, and groups whose items are all withdrawn vanish.
    """
    sign = weight or "1"
    sums = items.groupBy("order_id", sale_key(grain, ts_column)).agg(
        F.expr(f"sum({sign}) AS n_items"),
        F.expr(f"sum(quantity * {sign}) AS pieces"),
        F.expr(f"sum({cents('price')} * quantity * {sign}) AS revenue_c"),
        F.expr(f"sum({cents('cost_price')} * quantity * {sign}) AS cost_c"),
        F.max(ts_column).alias("last_ts"),
    )
    return sums.where("n_items > 0") if weight else sums


def roll_up(sold: DataFrame, key: str, copies: str = "1") -> DataFrame:
    """Per-order sums to one row of metrics per sale key."""
    totals = sold.groupBy(key).agg(
        F.expr("max(last_ts) AS last_processed_ts"),
        F.expr("count(1) AS total_orders"),
        F.expr(f"sum(pieces * {copies}) AS total_items_sold"),
        F.expr(f"sum(revenue_c * {copies}) AS revenue_c"),
        F.expr(f"sum(cost_c * {copies}) AS cost_c"),
    )
    return finish(totals, key, "last_processed_ts")


def finish(totals: DataFrame, *leading: str) -> DataFrame:
    """Cents to money columns, with the derived measures."""
    return totals.selectExpr(
        *leading, "total_orders", "total_items_sold",
        f"{as_total('revenue_c')} AS total_revenue",
        f"{as_total('cost_c')} AS total_cost",
        f"{as_total('revenue_c - cost_c')} AS total_profit",
        f"{as_total(average_cents('revenue_c', 'total_orders'))} AS average_order_value",
    )


def sales_metrics(
    items: DataFrame,
    orders: DataFrame,
    grain: str = DAY,
    ts_column: str = "kafka_ts",
    weight: str | None = None,
) -> DataFrame:
    """Sales per day or per timestamp over the current items and orders."""
    counted = completed(orders).select("order_id")
    sold = order_sums(items, grain, ts_column, weight).join(counted, "order_id", "left_semi")
    return roll_up(sold, KEY_NAME[grain])


def sales_metrics_all_versions(
    items: DataFrame, orders: DataFrame, grain: str = DAY, ts_column: str = "kafka_ts"
) -> DataFrame:
    """Sales as the join of every item version with every Completed order version.

    Sums multiply with the number of Completed versions. That number is counted
    per order first, so the versions are never paired up.
    """
    versions = completed(orders).groupBy("order_id").agg(F.count(F.lit(1)).alias("copies"))
    sold = order_sums(items, grain, ts_column).join(versions, "order_id")
    return roll_up(sold, KEY_NAME[grain], copies="copies")


def days_from_timestamps(by_ts: DataFrame, items: DataFrame, orders: DataFrame) -> DataFrame:
    """Day metrics from per-timestamp metrics.

    Pieces and money add up over a day's timestamps. Orders do not (one order may
    sell at several timestamps), so they are counted again from the items.
    """
    money = by_ts.groupBy(F.to_date("ts").alias("sale_date")).agg(
        F.sum("total_items_sold").alias("total_items_sold"),
        F.expr(f"sum({cents('total_revenue')}) AS revenue_c"),
        F.expr(f"sum({cents('total_cost')}) AS cost_c"),
    )
    pairs = items.select("order_id", sale_key(DAY, "kafka_ts")).distinct()
    counts = (
        pairs.join(completed(orders).select("order_id"), "order_id", "left_semi")
        .groupBy("sale_date").agg(F.count(F.lit(1)).alias("total_orders"))
    )
    return finish(money.join(counts, "sale_date"), "sale_date")
