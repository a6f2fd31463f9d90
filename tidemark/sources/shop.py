"""The shop's tables and change log, derived from the benchmark's star schema.

    products      part                    cost is 70 % of the price, to the cent
    orders        orders                  F = Completed, O = Pending, P = Cancelled
    order_items   lineitem, price by part

The change log gives every row a history: an order starts Pending and gets its
status a day later; every tenth order repeats that update; every 97th is deleted
afterwards; items of every 13th order get one more piece a day later; every 5th product
gets dearer by ten a day later, and every 23rd is deleted on the day after. The rules
only decide which rows have more versions; every row is in the log. Items arrive at
quarters of a second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import as_money
from tidemark.functions.temporal import to_iso
from tidemark.schemas import ORDER_ITEMS, ORDERS, PRODUCTS, ShopTable
from tidemark.sources.feeds import topic_of

# The columns the shop is derived from; declared, so that no file is opened for them.
_COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_shipdate timestamp_ntz"
    ),
}
_STATUS_CODE = {"Completed": "F", "Pending": "O", "Cancelled": "P"}


def _table(spark: SparkSession, sf_dir: str, name: str, stream: bool = False) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if not stream:
        return spark.read.schema(_COLUMNS[name]).parquet(path)
    # A file stream wants a pattern or a folder, even for a single file.
    return spark.readStream.schema(_COLUMNS[name]).parquet(f"{path[:-1]}[{path[-1]}]")


def _round_cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def _priced_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    return part.selectExpr("*", f"{_round_cents('p_retailprice')} AS price_c").selectExpr(
        "p_partkey", "p_name", "p_size",
        f"{as_money('price_c')} AS price",
        f"{as_money('(price_c * 7 + 5) DIV 10')} AS cost_price",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = "TIMESTAMP '1995-01-01' + make_dt_interval(p_size)"
    return _priced_parts(spark, sf_dir).selectExpr(
        "concat('PROD-', p_partkey) AS product_id", "p_name AS product_name",
        "price", "cost_price", f"{listed} AS created_at", f"{listed} AS updated_at",
    )


def _order_rows(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    names = " ".join(f"WHEN '{code}' THEN '{name}'" for name, code in _STATUS_CODE.items())
    return _table(spark, sf_dir, "orders", stream).selectExpr(
        "o_orderkey", "o_orderstatus",
        "CAST(o_orderkey AS STRING) AS order_id",
        "CAST(o_custkey AS STRING) AS customer_id",
        f"CASE o_orderstatus {names} END AS status",
        f"{as_money(_round_cents('o_totalprice'))} AS total_amount",
        "CAST(o_orderdate AS TIMESTAMP) AS created_at",
    )


def orders(
    spark: SparkSession, sf_dir: str, status: str | None = None, stream: bool = False
) -> DataFrame:
    """Orders as the shop has them now.

    A wanted ``status`` is tested on the stored code, so that it reaches the scan.
    """
    rows = _order_rows(spark, sf_dir, stream)
    if status:
        rows = rows.where(F.col("o_orderstatus") == _STATUS_CODE[status])
    return rows.selectExpr(*ORDERS.columns[:-1], "created_at + INTERVAL 1 DAY AS updated_at")


def _item_rows(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    items = _table(spark, sf_dir, "lineitem", stream).selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "CAST(l_quantity AS BIGINT) AS quantity",
        "CAST(l_shipdate AS TIMESTAMP) AS created_at",
    )
    prices = _priced_parts(spark, sf_dir).select("p_partkey", "price", "cost_price")
    return items.join(prices, F.expr("l_partkey = p_partkey")).selectExpr(
        "l_orderkey",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "date_format(created_at, 'yyyyMMdd')) AS order_item_id",
        "CAST(l_orderkey AS STRING) AS order_id",
        "concat('PROD-', l_partkey) AS product_id",
        "quantity", "price", "cost_price", "created_at",
        "created_at + make_dt_interval(0, l_linenumber, 0, l_orderkey % 4 * 0.25BD) AS kafka_ts",
    )


def order_items(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Items as the shop has them now, with their arrival time in the warehouse."""
    rows = _item_rows(spark, sf_dir, stream)
    return rows.selectExpr(*ORDER_ITEMS.columns[:-1], "created_at AS updated_at", "kafka_ts")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of orders: op, the row's columns, event_ts and offset.

    A delete keeps only the key.
    """
    versions = (
        "explode(filter(array(1, 2, 3, 4), v -> v <= 2 OR (v = 3 AND o_orderkey % 10 = 0)"
        " OR (v = 4 AND o_orderkey % 97 = 0))) AS version"
    )
    log = _order_rows(spark, sf_dir).selectExpr("*", versions).selectExpr(
        "version", "o_orderkey", "order_id", "customer_id", "total_amount", "created_at",
        "CASE version WHEN 1 THEN 'c' WHEN 4 THEN 'd' ELSE 'u' END AS op",
        "IF(version = 1, 'Pending', status) AS status",
        "created_at + make_dt_interval(version - 1) AS updated_at",
    )
    image = [f"IF(op <> 'd', {c}, NULL) AS {c}" for c in ORDERS.columns if c != "order_id"]
    return log.selectExpr(
        "op", "order_id", *image, "updated_at AS event_ts", "o_orderkey * 4 + version AS offset"
    )


def order_item_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of order items, as ``order_changes``."""
    versions = "explode(IF(l_orderkey % 13 = 0, array(1, 2), array(1))) AS version"
    return _item_rows(spark, sf_dir).selectExpr("*", versions).selectExpr(
        "IF(version = 1, 'c', 'u') AS op",
        "order_item_id", "order_id", "product_id", "quantity + version - 1 AS quantity",
        "price", "cost_price", "created_at",
        "created_at + make_dt_interval(version - 1) AS updated_at",
        "kafka_ts + make_dt_interval(version - 1) AS event_ts",
        "l_orderkey * 4 + version AS offset",
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows of products, as ``order_changes``."""
    versions = (
        "explode(filter(array(1, 2, 3), v -> v = 1 OR (v = 2 AND number % 5 = 0)"
        " OR (v = 3 AND number % 23 = 0))) AS version"
    )
    log = (
        products(spark, sf_dir)
        .withColumn("number", F.expr("CAST(substring(product_id, 6) AS BIGINT)"))
        .selectExpr("*", versions)
    )
    image = {
        "price": "CAST(price + IF(version = 2, 10, 0) AS DECIMAL(10, 2))",
        "updated_at": "created_at + make_dt_interval(version - 1)",
    }
    return log.selectExpr(
        "CASE version WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op", "product_id",
        *(f"IF(version < 3, {image.get(c, c)}, NULL) AS {c}"
          for c in PRODUCTS.columns if c != "product_id"),
        "created_at + make_dt_interval(version - 1) AS event_ts",
        "number * 4 + version AS offset",
    )


def _records(changes: DataFrame, table: ShopTable) -> DataFrame:
    image = [
        to_iso(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in table.schema
    ]
    after = F.when(F.col("op") != "d", F.struct(*image))
    return changes.select(
        F.lit(topic_of(table.name)).alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.col("event_ts").alias("timestamp"),
        F.to_json(F.struct(table.key)).alias("key"),
        F.to_json(F.struct("op", after.alias("after"))).alias("value"),
    )


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(order_changes(spark, sf_dir), ORDERS)


def order_item_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(order_item_changes(spark, sf_dir), ORDER_ITEMS)


def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(product_changes(spark, sf_dir), PRODUCTS)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined feed of all three tables, as change capture emits it."""
    return (
        order_feed(spark, sf_dir)
        .unionByName(order_item_feed(spark, sf_dir))
        .unionByName(product_feed(spark, sf_dir))
    )
