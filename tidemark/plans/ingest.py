"""Load one day of the CSV extracts into the source tables by keyed upsert.

The tables are kept in hash buckets of their key; a load rewrites only the buckets its rows
fall into. Orders and items of a load are published together or not at all: readers see both
tables as they were before the load, or both as they are after it. The load is checked while it
is written, and refused if a key is repeated, a needed column is empty or a status is unknown.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.upserts import keyed_upsert, one_row_per_key, with_defaults
from tidemark.schemas import ORDER_ITEMS, ORDERS, ShopTable
from tidemark.session import at_once
from tidemark.settings import ORDER_STATUSES
from tidemark.sinks.tables import BUCKET, fixed_buckets, overwrite, values_of, with_bucket
from tidemark.sinks.versions import Checks, Pointer, TableLoad, VersionedTables
from tidemark.sources.extracts import read_extract, rows_of_day, typed

BUCKETS = 64


def _stored_schema(table: ShopTable) -> T.StructType:
    return T.StructType([*table.schema, T.StructField(BUCKET, T.IntegerType())])


CHECKS = {
    ORDERS.name: Checks(("order_id", "customer_id"), {"status": ORDER_STATUSES}, ("order_id",)),
    ORDER_ITEMS.name: Checks(
        ("order_item_id", "order_id", "product_id", "quantity", "price"), unique=("order_item_id",)),
}


def source_table(
    spark: SparkSession, root: str, table: ShopTable, pointer: Pointer | None = None
) -> DataFrame:
    """A source table; several are read as of one load by the same ``pointer``."""
    rows = VersionedTables(root).read(spark, table.name, _stored_schema(table), pointer)
    return rows.select(*table.columns)


def create_table(rows: DataFrame, root: str, table: ShopTable, buckets: int = BUCKETS) -> None:
    """Drop and recreate a source table from rows with unique keys.

    The number of buckets belongs to the table from then on.
    """
    spark, tables = rows.sparkSession, VersionedTables(root)
    count = spark.range(1).select(F.lit(buckets).alias("buckets"))
    overwrite(count, _count_path(root, table))
    laid_out = with_bucket(rows.select(*table.columns), table.key, buckets)
    held = map(int, tables.pointer(spark).get(table.name, {}))
    load = TableLoad(laid_out, BUCKET, sorted({*held, *range(buckets)}), CHECKS.get(table.name, Checks()))
    tables.publish(spark, tables.next_load(spark, f"create-{table.name}"), {table.name: load})


def _count_path(root: str, table: ShopTable) -> str:
    return f"{root}/_buckets/{table.name}"


def upserted_buckets(
    spark: SparkSession, root: str, incoming: DataFrame, table: ShopTable, pointer: Pointer,
    buckets: int | None = None,
) -> TableLoad:
    """The new content of the buckets the incoming rows fall into.

    Only rows of the incoming keys take part in the upsert. They are looked up, so that the rest
    of the buckets does not move for it where few rows come in.
    """
    buckets = fixed_buckets(spark, _count_path(root, table), buckets, BUCKETS)
    rows = with_defaults(one_row_per_key(incoming, table), table)
    touched = values_of(with_bucket(incoming.select(table.key), table.key, buckets), BUCKET)
    target = VersionedTables(root).read(
        spark, table.name, _stored_schema(table), pointer, touched)
    keys = incoming.select(table.key)
    met, others = (target.join(keys, table.key, how) for how in ("left_semi", "left_anti"))
    merged = others.select(*table.columns).unionByName(keyed_upsert(met, rows, table))
    return TableLoad(
        with_bucket(merged, table.key, buckets), BUCKET, touched, CHECKS[table.name])


def ingest_day(
    spark: SparkSession,
    root: str,
    day: str,
    orders_csv: str,
    items_csv: str,
    buckets: int | None = None,
) -> dict[str, dict[str, int]]:
    """Upsert the extract rows last updated on ``day`` (``yyyy-MM-dd``); what was counted.

    Running a day again changes nothing; errors are raised and leave the tables as they were.
    ``buckets`` need not be given; one that is not the tables' own is refused.
    """
    tables = VersionedTables(root)
    pointer, outcome = tables.pointer(spark), {}

    def rows(table: ShopTable, path: str) -> DataFrame:
        """The day's rows, taken out of the extract once: it holds all other days' too."""
        held = f"{root}/_incoming/{table.name}"
        overwrite(typed(rows_of_day(read_extract(spark, path, table), day), table), held)
        return spark.read.schema(table.schema).parquet(held)

    extracts = ((ORDERS, orders_csv), (ORDER_ITEMS, items_csv))
    incoming = at_once(*(partial(rows, table, path) for table, path in extracts))
    for (table, _), new in zip(extracts, incoming, strict=True):
        outcome[table.name] = upserted_buckets(spark, root, new, table, pointer, buckets)
    return tables.publish(spark, tables.next_load(spark, f"day-{day}"), outcome)
