"""Registered queries: each operator and job over the shop's whole tables.

Results use types every engine prints alike: dates and timestamps as text, money
as doubles of whole cents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import settings
from tidemark.operators import checks, sales, upserts
from tidemark.operators.changes import current_rows, flatten
from tidemark.plans import arrival_index, colocated, incremental, ingest, rollups
from tidemark.schemas import ORDER_ITEMS, ORDERS, PRODUCTS, ShopTable
from tidemark.session import let_go, stateful_session, work_dir
from tidemark.sinks import tables, versions, zorder
from tidemark.sources import extracts, feeds, shop
from tidemark.streaming import closing, joined, views
from tidemark.streaming.revising import RevisingSales

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of single queries; the SQL in ``oracle`` uses the same ones.
MARK = "1998-01-01 00:00:00"
BEFORE_ALL = "1990-01-01 00:00:00"
INGEST_DAY = "1998-06-15"
KEEP_FROM = "1999-07-15"
PRICE_CUT = "910"
LATE_OFFSET = 5
LOAD_DAYS = ("1998-06-14", "1998-06-15", "1998-06-16")


def portable(rows: DataFrame) -> DataFrame:
    def column(field: T.StructField) -> str:
        if isinstance(field.dataType, T.DateType):
            return f"date_format({field.name}, 'yyyy-MM-dd') AS {field.name}"
        if isinstance(field.dataType, T.TimestampType):
            return f"date_format({field.name}, 'yyyy-MM-dd HH:mm:ss.SSS') AS {field.name}"
        if isinstance(field.dataType, T.DecimalType):
            return f"CAST({field.name} AS DOUBLE) AS {field.name}"
        return field.name

    return rows.selectExpr(*map(column, rows.schema))


# Metrics in batch -----------------------------------------------------------------


def sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.orders(spark, sf_dir, settings.COMPLETED)
    return sales.sales_metrics(shop.order_items(spark, sf_dir), orders)


def sales_by_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.orders(spark, sf_dir, settings.COMPLETED)
    metrics = sales.sales_metrics(shop.order_items(spark, sf_dir), orders, sales.TIMESTAMP)
    return metrics.drop("last_processed_ts")


def sales_ts_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-timestamp metrics through the metrics feed, rolled up to days."""
    records = feeds.encode_metrics(sales_by_ts(spark, sf_dir))
    orders = shop.orders(spark, sf_dir, settings.COMPLETED)
    return sales.days_from_timestamps(
        feeds.decode_metrics(records), shop.order_items(spark, sf_dir), orders
    )


def metrics_feed_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics records as the summary view takes them: timestamp cut to the date."""
    return views.metrics_days(
        feeds.decode_metrics(feeds.encode_metrics(sales_by_ts(spark, sf_dir)))
    )


def sales_daily_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales from items and orders stored in buckets of the order."""
    root = work_dir(spark, "colocated")
    name = "sales_" + root.rpartition("-")[2]
    stored = colocated.ColocatedSales(f"{root}/tables", name, _buckets(spark))
    stored.store(spark, shop.order_items(spark, sf_dir), shop.orders(spark, sf_dir))
    return stored.metrics(spark)


def _rollups(spark: SparkSession, sf_dir: str, grain: str) -> rollups.SalesRollups:
    """Stored sales rows of a grain; orders are numbered in two loads."""
    stored = rollups.SalesRollups(work_dir(spark, f"rollups-{grain}"))
    orders = shop.orders(spark, sf_dir)
    stored.number_orders(spark, orders.where(F.col("created_at") < MARK), "first")
    stored.number_orders(spark, orders, "second")
    stored.store(spark, shop.order_items(spark, sf_dir),
                 shop.orders(spark, sf_dir, settings.COMPLETED), grain)
    return stored


def sales_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per week from the days' stored bitmaps and sums, without the items."""
    return _rollups(spark, sf_dir, sales.DAY).roll_up(spark, sales.DAY, "week", "sale_week")


def sales_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``sales_weekly``, per month."""
    return _rollups(spark, sf_dir, sales.DAY).roll_up(spark, sales.DAY, "month", "sale_month_start")


def sales_stamps_to_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per day from the timestamps' stored rows, without the items."""
    return _rollups(spark, sf_dir, sales.TIMESTAMP).roll_up(
        spark, sales.TIMESTAMP, "day", "sale_date")


def _arrivals(changes: DataFrame) -> DataFrame:
    return changes.withColumnRenamed("event_ts", "kafka_ts")


def sales_daily_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_metrics_all_versions(
        _arrivals(shop.order_item_changes(spark, sf_dir).where("op != 'd'")),
        shop.order_changes(spark, sf_dir).where("op != 'd'"),
    )


def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.high_water_mark(sales_daily(spark, sf_dir))


def sales_daily_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shop.orders(spark, sf_dir, settings.COMPLETED)
    return incremental.new_rows_only(shop.order_items(spark, sf_dir), orders, MARK)


def daily_summary_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments: what arrived before the mark, then everything."""
    root = work_dir(spark, "summary")
    arrivals = {
        "order_items": _arrivals(shop.order_item_changes(spark, sf_dir)),
        "orders": _arrivals(shop.order_changes(spark, sf_dir)),
    }
    for step, part in enumerate((F.col("kafka_ts") < MARK, F.col("kafka_ts") >= MARK)):
        for name, rows in arrivals.items():
            arrived = arrival_index.by_arrival(rows.where(part))
            tables.spread(arrived, arrival_index.ARRIVAL_MONTH).write.mode("append").option(
                "compression", tables.CODEC).partitionBy(arrival_index.ARRIVAL_MONTH).parquet(f"{root}/{name}")
            let_go(spark)
        incremental.run_incremental(
            spark,
            spark.read.parquet(f"{root}/order_items"),
            spark.read.parquet(f"{root}/orders"),
            f"{root}/sales", f"{root}/days-{step}", BEFORE_ALL, _buckets(spark),
        )
    return incremental.summary(spark, f"{root}/sales").drop(tables.MONTH)


# Change feeds ---------------------------------------------------------------------


def _flattened(feed: DataFrame, table: ShopTable) -> DataFrame:
    return flatten(feeds.decode_json(feed, table), table)


def cdc_flatten_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(shop.order_feed(spark, sf_dir), ORDERS)


def cdc_flatten_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(shop.order_item_feed(spark, sf_dir), ORDER_ITEMS)


def cdc_flatten_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flattened(shop.product_feed(spark, sf_dir), PRODUCTS)


def cdc_table_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per topic of a feed narrowed to orders and order items."""
    selected = feeds.select_tables(shop.change_feed(spark, sf_dir), ("orders", "order_items"))
    return selected.groupBy("topic").agg(F.count(F.lit(1)).alias("n_records"))


def cdc_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(cdc_flatten_orders(spark, sf_dir), ORDERS).drop("op", "offset")


def cdc_latest_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(cdc_flatten_order_items(spark, sf_dir), ORDER_ITEMS).drop("op", "offset")


def cdc_latest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(cdc_flatten_products(spark, sf_dir), PRODUCTS).drop("op", "offset")


# Loads and upserts ----------------------------------------------------------------


def ingest_day_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = shop.orders(spark, sf_dir).withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSS")
    )
    return extracts.rows_of_day(text, INGEST_DAY)


def _buckets(spark: SparkSession) -> int:
    """As many hash buckets as the cluster has cores, so that all take part in a rewrite."""
    return spark.sparkContext.defaultParallelism


def _inserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as first inserted, those created before the mark."""
    first = shop.order_changes(spark, sf_dir).where("op = 'c'")
    return first.where(F.col("created_at") < MARK).select(*ORDERS.columns)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All updates applied to the orders inserted before the mark; the rest are new.

    The updates carry another customer, which known orders must not take over, and those of
    every 11th order no amount, which is 0 by default.
    """
    updates = shop.order_changes(spark, sf_dir).where("op = 'u'").withColumn(
        "customer_id", F.concat(F.lit("moved-"), "customer_id")
    ).withColumn("total_amount", F.expr("IF(order_id % 11 <> 0, total_amount, NULL)"))
    incoming = upserts.one_row_per_key(updates.select(*ORDERS.columns), ORDERS)
    return upserts.keyed_upsert(
        _inserted_orders(spark, sf_dir), upserts.with_defaults(incoming, ORDERS), ORDERS
    )


def upsert_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items created before the mark, upserted with all item changes."""
    changes = shop.order_item_changes(spark, sf_dir)
    known = changes.where((F.col("op") == "c") & (F.col("created_at") < MARK))
    incoming = upserts.one_row_per_key(changes.select(*ORDER_ITEMS.columns), ORDER_ITEMS)
    return upserts.keyed_upsert(
        known.select(*ORDER_ITEMS.columns),
        upserts.with_defaults(incoming, ORDER_ITEMS), ORDER_ITEMS,
    )


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products under the price cut, plus all others; known ones keep their name."""
    every = shop.products(spark, sf_dir)
    known = every.where(F.col("price") < F.lit(PRICE_CUT).cast("decimal(10,2)"))
    offered = every.withColumn("product_name", F.upper("product_name"))
    return upserts.insert_if_absent(known, offered, "product_id")


def _ingested(spark: SparkSession, sf_dir: str) -> str:
    """Write extracts as CSV, create the source tables and load three days."""
    root = work_dir(spark, "ingest")
    orders, items = shop.order_changes(spark, sf_dir), shop.order_item_changes(spark, sf_dir)
    for rows, table in ((orders, ORDERS), (items, ORDER_ITEMS)):
        extract = rows.where("op != 'd'").select(
            *(F.col(f.name).cast("string").alias(f.name) for f in table.schema)
        )
        extract.write.option("header", True).option("compression", "gzip").csv(
            f"{root}/{table.name}.csv")
        let_go(spark)
    buckets = _buckets(spark)
    ingest.create_table(_inserted_orders(spark, sf_dir), root, ORDERS, buckets)
    first_items = items.where((F.col("op") == "c") & (F.col("created_at") < MARK))
    ingest.create_table(first_items, root, ORDER_ITEMS, buckets)
    for day in LOAD_DAYS:
        ingest.ingest_day(
            spark, root, day, f"{root}/orders.csv", f"{root}/order_items.csv", buckets
        )
        # Nobody reads by the pointer of an earlier load here.
        versions.VersionedTables(root).vacuum(spark)
    return root


def csv_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.source_table(spark, _ingested(spark, sf_dir), ORDERS)


def csv_ingest_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.source_table(spark, _ingested(spark, sf_dir), ORDER_ITEMS)


def csv_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A products extract, which has dates without a time, read back and typed."""
    path = f"{work_dir(spark, 'extract')}/products.csv"
    dates = ("created_at", "updated_at")
    shop.products(spark, sf_dir).select(*(
        F.date_format(c, "yyyy-MM-dd").alias(c) if c in dates else F.col(c).cast("string").alias(c)
        for c in PRODUCTS.columns
    )).write.option("header", True).csv(path)
    return extracts.typed(extracts.read_extract(spark, path, PRODUCTS), PRODUCTS)


# Checks ---------------------------------------------------------------------------


def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the item log that more than one version shares."""
    return checks.duplicate_keys(shop.order_item_changes(spark, sf_dir), ["order_item_id"])


def output_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that the metrics topic's summary view holds in more than one row."""
    return checks.duplicate_keys(metrics_feed_to_day(spark, sf_dir), ["ts"])


def not_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.null_counts(shop.order_changes(spark, sf_dir), ORDERS.columns)


def _deleted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop.order_changes(spark, sf_dir).where("op = 'd'")


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose order the change log has deleted."""
    live = current_rows(shop.order_changes(spark, sf_dir), ORDERS)
    items = shop.order_items(spark, sf_dir)
    return checks.orphans(items, live, "order_id").select("order_item_id", "order_id")


def fk_cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = checks.cascade_delete(
        shop.order_items(spark, sf_dir), _deleted_orders(spark, sf_dir), "order_id"
    )
    return left.select("order_item_id", "order_id")


def fk_restrict_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products over the price cut that cannot be deleted, as items refer to them."""
    over = F.col("price") >= F.lit(PRICE_CUT).cast("decimal(10,2)")
    requested = shop.products(spark, sf_dir).where(over)
    return checks.restricted_deletes(shop.order_items(spark, sf_dir), requested, "product_id")


def status_enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of the order log; every 50th order has its in capitals, deletes have none."""
    status = F.expr("IF(order_id % 50 = 0, upper(status), status)").alias("status")
    return checks.disallowed_values(
        shop.order_changes(spark, sf_dir).select(status), "status", settings.ORDER_STATUSES
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source orders against the current rows of the change log."""
    arrived = current_rows(shop.order_changes(spark, sf_dir), ORDERS)
    columns = [c for c in ORDERS.columns if c != "order_id"]
    return checks.reconcile(shop.orders(spark, sf_dir), arrived, "order_id", columns)


def reconcile_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``reconcile``, looking for ranges of keys that differ before any rows are joined."""
    arrived = current_rows(shop.order_changes(spark, sf_dir), ORDERS)
    columns = [c for c in ORDERS.columns if c != "order_id"]
    return checks.reconcile_by_digests(
        shop.orders(spark, sf_dir), arrived, "order_id", columns, work_dir(spark, "digests"))


# Storage --------------------------------------------------------------------------


def _stored(spark: SparkSession, rows: DataFrame, table: ShopTable) -> DataFrame:
    path = work_dir(spark, table.name)
    tables.append_sorted(rows, path, table)
    return spark.read.parquet(path)


def store_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, shop.products(spark, sf_dir), PRODUCTS)
    return stored.select(*PRODUCTS.columns, F.col("kafka_ts").isNotNull().alias("stamped"))


def store_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, shop.orders(spark, sf_dir), ORDERS)
    return stored.select(
        *ORDERS.columns, F.col("kafka_ts").isNotNull().alias("stamped"), "created_month"
    )


def store_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, shop.order_items(spark, sf_dir), ORDER_ITEMS)
    return stored.select(*ORDER_ITEMS.columns, "kafka_ts", "created_month")


def store_items_by_day_and_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items stored along a curve through days and orders, summed by day as they are read back."""
    path = work_dir(spark, "curve")
    zorder.write_z_ordered(
        shop.order_items(spark, sf_dir), path, "kafka_ts", "order_id", 4 * _buckets(spark))
    return spark.read.parquet(path).groupBy(F.to_date("kafka_ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("quantity").alias("quantity"),
        F.min("order_id").alias("first_order"))


def load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What writing the order log counted: it is refused, and the items are not.

    Every 50th status is in capitals, deletes have none, and an order has several versions.
    """
    status = F.expr("IF(order_id % 50 = 0, upper(status), status)")
    wanted = {
        "orders": (
            shop.order_changes(spark, sf_dir).withColumn("status", status),
            versions.Checks(("customer_id",), {"status": settings.ORDER_STATUSES}, ("order_id",))),
        "items": (
            shop.order_items(spark, sf_dir),
            versions.Checks(("order_id", "kafka_ts"), unique=("order_item_id",))),
    }
    stored, found = versions.VersionedTables(work_dir(spark, "checked")), []
    for name, (rows, checked) in wanted.items():
        load = versions.TableLoad(
            tables.with_bucket(rows, "order_id", _buckets(spark)), tables.BUCKET, checks=checked)
        try:
            report = stored.publish(spark, f"load-{name}", {name: load})
        except versions.RefusedLoad as refused:
            report = refused.report
        found += [(name, check, n, name in stored.pointer(spark)) for check, n in report[name].items()]
    return spark.createDataFrame(found, "table string, check string, n long, published boolean")


def _by_month(spark: SparkSession, rows: DataFrame, day: str, label: str) -> str:
    path = work_dir(spark, label)
    tables.overwrite(
        tables.spread(tables.with_month(rows, day), tables.MONTH), path, tables.MONTH
    )
    return path


def sales_monthly_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales stored by month, one year read back by its partitions."""
    path = _by_month(spark, sales_daily(spark, sf_dir), "sale_date", "monthly")
    year = F.col(tables.MONTH).between(199801, 199812)
    return spark.read.parquet(path).where(year)


def ttl_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items kept from a day on, summed by month."""
    path = _by_month(spark, shop.order_items(spark, sf_dir), "kafka_ts", "retention")
    tables.expire_before(spark, path, KEEP_FROM, "kafka_ts")
    return spark.read.parquet(path).groupBy(tables.MONTH).agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("quantity").alias("quantity")
    )


# Streams --------------------------------------------------------------------------


def _land(records: DataFrame, path: str) -> None:
    """Add records to a landed feed; what the query before it has shuffled goes meanwhile."""
    let_go(records.sparkSession)
    records.write.mode("append").option("compression", tables.CODEC).parquet(path)
    let_go(records.sparkSession)


def _streamed_sales(
    spark: SparkSession, sf_dir: str, grain: str,
    on_revised: Callable[[DataFrame], None] | None = None,
    after_part: Callable[[], None] = lambda: None,
) -> DataFrame:
    """Land the feed in two parts and run the job after each, from its checkpoint."""
    root = work_dir(spark, f"stream-{grain}")
    feed = shop.order_feed(spark, sf_dir).unionByName(shop.order_item_feed(spark, sf_dir))
    job = RevisingSales(f"{root}/state", grain, _buckets(spark))
    for part in (F.col("timestamp") < MARK, F.col("timestamp") >= MARK):
        _land(feed.where(part), f"{root}/feed")
        landed = feeds.file_feed(spark, f"{root}/feed")
        job.start(landed, run_once=True, on_revised=on_revised).awaitTermination()
        after_part()
    return job.result(spark)


def stream_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_sales(spark, sf_dir, sales.DAY)


def stream_sales_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed_sales(spark, sf_dir, sales.TIMESTAMP)


def stream_metrics_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revising job's metrics through the metrics feed into one row per day."""
    root = work_dir(spark, "metrics")

    def send(rows: DataFrame) -> None:
        feeds.encode_metrics(rows).selectExpr(
            "topic", "0 AS partition", "0L AS offset", "current_timestamp() AS timestamp",
            "key", "value",
        ).write.mode("append").parquet(f"{root}/feed")

    def take_in() -> None:
        views.maintain_metrics_days(
            feeds.file_feed(spark, f"{root}/feed"), f"{root}/view", run_once=True
        ).awaitTermination()

    _streamed_sales(spark, sf_dir, sales.DAY, send, take_in)
    return views.stored_metrics_days(spark, f"{root}/view")


def _viewed(spark: SparkSession, feed: DataFrame, table: ShopTable) -> str:
    """The feed through a continuous view; the stored table's path."""
    root = work_dir(spark, "view")
    feed.write.parquet(f"{root}/feed")
    views.maintain_table(
        feeds.file_feed(spark, f"{root}/feed"), table, f"{root}/{table.name}",
        f"{root}/progress", run_once=True,
    ).awaitTermination()
    return f"{root}/{table.name}"


def stream_cdc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order feed through a continuous view into the stored table."""
    path = _viewed(spark, shop.order_feed(spark, sf_dir), ORDERS)
    return spark.read.parquet(path).select(*ORDERS.columns)


def stream_cdc_flatten_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _viewed(spark, shop.order_item_feed(spark, sf_dir), ORDER_ITEMS)
    return spark.read.parquet(path).select(*ORDER_ITEMS.columns)


def stream_cdc_flatten_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _viewed(spark, shop.product_feed(spark, sf_dir), PRODUCTS)
    return spark.read.parquet(path).select(*PRODUCTS.columns)


def stream_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a feed with broken records and amounts that are no numbers: stored or aside.

    Every 29th record breaks off, every 31st has a word for an amount.
    """
    value = """CASE WHEN offset % 29 = 0 THEN substring(value, 1, 6) WHEN offset % 31 = 0
        THEN regexp_replace(value, '"total_amount":[0-9.]+', '"total_amount":"much"')
        ELSE value END"""
    feed = shop.order_feed(spark, sf_dir).withColumn("value", F.expr(value))
    path = _viewed(spark, feed, ORDERS)
    stored, aside = spark.read.parquet(path), spark.read.parquet(f"{path}_aside")
    return stored.selectExpr("order_id", "total_amount", "'stored' AS verdict").unionByName(
        aside.selectExpr(
            "row_key AS order_id", "CAST(NULL AS DECIMAL(10, 2)) AS total_amount",
            "'aside' AS verdict"))


def stream_sales_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales by a stateful join of the change feeds, without a time bound.

    The feed comes in two parts; the second run goes on from the first one's state.
    """
    root = work_dir(spark, "append")
    streams = stateful_session(spark)
    feed = shop.order_feed(spark, sf_dir).unionByName(shop.order_item_feed(spark, sf_dir))
    for part in (F.col("timestamp") < MARK, F.col("timestamp") >= MARK):
        _land(feed.where(part), f"{root}/feed")
        joined.start_joined_sales(
            spark, feeds.file_feed(streams, f"{root}/feed"), f"{root}/state", run_once=True
        ).awaitTermination()
    return joined.joined_sales(spark, f"{root}/state")


def stream_closing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days sent once when the 10 s watermark has passed them, and what came too late for them.

    The feed comes in two parts, before and from the mark on; some items of the first are held
    back and come with the second.
    """
    root = work_dir(spark, "closing")
    streams = stateful_session(spark)
    feed = shop.order_feed(spark, sf_dir).unionByName(shop.order_item_feed(spark, sf_dir))
    held_back = F.col("topic").endswith("order_items") & (F.col("offset") % 17 == LATE_OFFSET)
    first = (F.col("timestamp") < MARK) & ~held_back
    for part in (first, ~first):
        _land(feed.where(part), f"{root}/feed")
        closing.start_closing_days(
            feeds.file_feed(streams, f"{root}/feed"), f"{root}/state", run_once=True
        ).awaitTermination()
    kept = ("sale_date", "total_orders", "total_items_sold", "total_revenue", "total_cost")
    final = closing.final_days(spark, f"{root}/state").select(*kept, F.lit("final").alias("kind"))
    late = closing.late_differences(spark, f"{root}/state")
    return final.unionByName(late.select(*kept, F.lit("late").alias("kind")))


REGISTERED: dict[str, Query] = {
    q.__name__: q
    for q in (
        sales_daily, sales_by_ts, sales_ts_to_day, metrics_feed_to_day,
        sales_weekly, sales_monthly, sales_stamps_to_day, sales_daily_colocated,
        sales_daily_all_versions, high_water_mark, sales_daily_incremental,
        daily_summary_merge, cdc_flatten_orders, cdc_flatten_order_items,
        cdc_flatten_products, cdc_table_filter, cdc_latest_orders,
        cdc_latest_order_items, cdc_latest_products, ingest_day_filter, upsert_orders,
        upsert_order_items, insert_if_absent, csv_ingest_orders, csv_ingest_order_items,
        csv_products,
        pk_duplicates, output_key_check, not_null_counts, fk_orphans, fk_cascade_delete,
        fk_restrict_violations, status_enum_violations, reconcile, reconcile_digests, store_products,
        store_orders, store_order_items, store_items_by_day_and_order,
        load_checks, sales_monthly_partitions, ttl_retention,
        stream_sales_daily, stream_sales_ts, stream_sales_append, stream_metrics_days,
        stream_cdc_flatten, stream_cdc_flatten_items, stream_cdc_flatten_products,
        stream_set_aside, stream_closing_days,
    )
}


def _reported(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, Query]:
    return {name: _reported(query) for name, query in REGISTERED.items()}
