"""Declared schemas, keys and update rules of the shop tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
TOTAL = T.DecimalType(18, 2)


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class ShopTable:
    """One table: its columns, its key and what an update may change.

    ``mutable`` lists the columns a later row with the same key replaces; all
    others keep the value they were inserted with. ``defaults`` fill columns that
    arrive empty, as SQL text. ``sort`` is the storage order.
    """

    name: str
    schema: T.StructType
    key: str
    mutable: tuple[str, ...]
    sort: tuple[str, ...]
    month_of: str | None = None
    defaults: tuple[tuple[str, str], ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def wire_schema(self) -> T.StructType:
        """The row as it travels in a change event: timestamps are ISO-8601 text."""
        return T.StructType([
            T.StructField(
                f.name,
                T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType,
            )
            for f in self.schema
        ])

    @property
    def text_schema(self) -> T.StructType:
        """The row as it lies in an extract file: all text, cast column by column."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.columns])


_NOW = "current_timestamp()"
_AUDIT_DEFAULTS = (("created_at", _NOW), ("updated_at", _NOW))

PRODUCTS = ShopTable(
    name="products",
    schema=_fields(
        product_id=T.StringType(),
        product_name=T.StringType(),
        price=MONEY,
        cost_price=MONEY,
        created_at=T.TimestampType(),
        updated_at=T.TimestampType(),
    ),
    key="product_id",
    mutable=("product_name", "price", "cost_price", "updated_at"),
    sort=("product_id",),
    defaults=_AUDIT_DEFAULTS,
)

ORDERS = ShopTable(
    name="orders",
    schema=_fields(
        order_id=T.StringType(),
        customer_id=T.StringType(),
        status=T.StringType(),
        total_amount=MONEY,
        created_at=T.TimestampType(),
        updated_at=T.TimestampType(),
    ),
    key="order_id",
    mutable=("status", "total_amount", "updated_at"),
    sort=("to_date(created_at)", "order_id"),
    month_of="created_at",
    defaults=(("total_amount", "0.00"), *_AUDIT_DEFAULTS),
)

# Quantities are unsigned 32-bit in the warehouse, hence a long here.
ORDER_ITEMS = ShopTable(
    name="order_items",
    schema=_fields(
        order_item_id=T.StringType(),
        order_id=T.StringType(),
        product_id=T.StringType(),
        quantity=T.LongType(),
        price=MONEY,
        cost_price=MONEY,
        created_at=T.TimestampType(),
        updated_at=T.TimestampType(),
    ),
    key="order_item_id",
    mutable=("quantity", "price", "cost_price", "updated_at"),
    sort=("to_date(created_at)", "order_id"),
    month_of="created_at",
    defaults=_AUDIT_DEFAULTS,
)

TABLES = {t.name: t for t in (PRODUCTS, ORDERS, ORDER_ITEMS)}

# A record of the metrics topic: flat, keyed by the event timestamp.
METRICS_RECORD = _fields(
    ts=T.TimestampType(),
    total_orders=T.LongType(),
    total_items_sold=T.LongType(),
    total_revenue=TOTAL,
    total_cost=TOTAL,
    total_profit=TOTAL,
    average_order_value=TOTAL,
)

# One change-feed record, whatever carries it (broker or files).
FEED_RECORD = _fields(
    topic=T.StringType(),
    partition=T.IntegerType(),
    offset=T.LongType(),
    timestamp=T.TimestampType(),
    key=T.StringType(),
    value=T.StringType(),
)
