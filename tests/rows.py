"""Small hand-made tables and feed records."""

from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

from tidemark.schemas import FEED_RECORD, ORDER_ITEMS, ORDERS
from tidemark.sources.feeds import topic_of


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def orders(spark, *rows):
    """(order_id, status)"""
    return spark.createDataFrame(list(rows), "order_id string, status string")


def items(spark, *rows):
    """(order_id, quantity, price, cost, kafka_ts)"""
    return spark.createDataFrame(
        [(o, q, Decimal(p), Decimal(c), at(ts)) for o, q, p, c, ts in rows],
        "order_id string, quantity bigint, price decimal(10,2), cost_price decimal(10,2), "
        "kafka_ts timestamp",
    )


def metrics(df) -> dict:
    """Sale key to (orders, pieces, revenue, cost, profit, average)."""
    out = {}
    for row in df.collect():
        values = row.asDict()
        key = str(values.get("sale_date", values.get("ts")))
        out[key] = (
            values["total_orders"], values["total_items_sold"], *(
                str(values[c]) for c in
                ("total_revenue", "total_cost", "total_profit", "average_order_value")
            ),
        )
    return out


def order_record(offset, ts, op, order_id, status=None):
    after = None
    if op != "d":
        after = {
            "order_id": order_id, "customer_id": "C1", "status": status, "total_amount": 1.5,
            "created_at": "2024-01-01T00:00:00Z", "updated_at": ts.replace(" ", "T") + "Z",
        }
    return record("orders", ORDERS.key, order_id, offset, ts, {"op": op, "after": after})


def item_record(offset, ts, op, item_id, order_id=None, quantity=1, price="10.00", cost="7.00"):
    after = None
    if op != "d":
        after = {
            "order_item_id": item_id, "order_id": order_id, "product_id": "PROD-1",
            "quantity": quantity, "price": float(price), "cost_price": float(cost),
            "created_at": "2024-01-01T00:00:00Z", "updated_at": ts.replace(" ", "T") + "Z",
        }
    return record("order_items", ORDER_ITEMS.key, item_id, offset, ts, {"op": op, "after": after})


def record(table, key_name, key, offset, ts, value):
    return (
        topic_of(table), 0, offset, at(ts), json.dumps({key_name: key}),
        None if value is None else json.dumps(value),
    )


def feed(spark, records):
    return spark.createDataFrame(list(records), FEED_RECORD)
