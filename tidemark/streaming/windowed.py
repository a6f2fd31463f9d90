"""Low-latency daily sales: watermarked stream join, one-day windows, append output.

Each day is emitted once, when the watermark has passed it. Late rows are dropped
and results never revised; ``revising`` is the exact job. Items are summed per day
and order before they meet the orders: an order with a third of all items reaches the
join as one row per day, and the join's state holds no single items. A day joins the
orders within ``early`` before and ``late`` after its end, and no others: items of orders
further away are left out. That bounds the join state, and it also holds the result back:
a day is final once the slower stream has passed it by ``late``. Where orders and items may
lie any time apart, use ``joined``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.money import cents
from tidemark.operators.sales import completed, finish
from tidemark.settings import WATERMARK_DELAY


def windowed_daily_sales(
    items: DataFrame, orders: DataFrame, early: str, late: str
) -> DataFrame:
    """Daily sales from two streams: items with ``ts``, orders with ``order_ts``.

    The orders stream must carry each Completed order once. After the join there is
    one row per day and order, so counting a day's orders is counting rows.
    """
    per_order = (
        items.withWatermark("ts", WATERMARK_DELAY)
        .groupBy(F.window("ts", "1 day"), "order_id").agg(
            F.sum("quantity").alias("pieces"),
            F.expr(f"sum({cents('price')} * quantity) AS revenue_c"),
            F.expr(f"sum({cents('cost_price')} * quantity) AS cost_c"),
        )
        .withColumn("day_end", F.window_time("window")).drop("window")
    )
    placed = (
        completed(orders).select(F.col("order_id").alias("completed_id"), "order_ts")
        .withWatermark("order_ts", WATERMARK_DELAY)
    )
    in_reach = F.expr(
        f"order_id = completed_id AND day_end >= order_ts - INTERVAL {early}"
        f" AND day_end <= order_ts + INTERVAL {late}"
    )
    per_day = per_order.join(placed, in_reach).groupBy(F.window("day_end", "1 day")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("pieces").alias("total_items_sold"),
        F.sum("revenue_c").alias("revenue_c"),
        F.sum("cost_c").alias("cost_c"),
    )
    return finish(per_day.withColumn("sale_date", F.to_date("window.start")), "sale_date")
