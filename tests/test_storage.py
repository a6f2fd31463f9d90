from __future__ import annotations

import time
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tidemark import session
from tidemark.plans.incremental import SUMMARY
from tidemark.schemas import ORDERS, PRODUCTS
from tidemark.sinks import tables, zorder
from tidemark.sources import shop


def test_append_is_sorted_compressed_and_stamped(spark, sf_dir, tmp_path):
    path = tmp_path / "orders"
    for _ in range(2):
        tables.append_sorted(shop.orders(spark, sf_dir), str(path), ORDERS)
    stored = spark.read.parquet(str(path))
    assert stored.count() == 3000 and stored.where("kafka_ts IS NULL").isEmpty()
    assert stored.select("kafka_ts").distinct().count() == 2
    files = list(path.glob("created_month=*/*.parquet"))
    assert files
    for file in files[:20]:
        part = pq.ParquetFile(file)
        assert part.metadata.row_group(0).column(0).compression == "ZSTD"
        order = [(r["created_at"].date(), r["order_id"]) for r in part.read().to_pylist()]
        assert order == sorted(order)


def test_months_are_pruned(spark, sf_dir, tmp_path):
    path = str(tmp_path / "orders")
    tables.append_sorted(shop.orders(spark, sf_dir), path, ORDERS)
    january = spark.read.parquet(path).where("created_month = 199801")
    assert "PartitionFilters: [isnotnull(created_month" in january._jdf.queryExecution().toString()
    assert all("created_month=199801" in f for f in january.inputFiles()) or not january.isEmpty()
    assert january.where("month(created_at) <> 1 OR year(created_at) <> 1998").isEmpty()


def test_products_need_no_partitions(spark, sf_dir, tmp_path):
    tables.append_sorted(shop.products(spark, sf_dir), str(tmp_path / "p"), PRODUCTS)
    ids = [r.product_id for r in spark.read.parquet(str(tmp_path / "p")).collect()]
    assert ids == sorted(ids) and len(ids) == 200


def summary_rows(spark, **days):
    return spark.createDataFrame(
        [(d.replace("_", "-").lstrip("d"), n) for d, n in days.items()], "day string, n bigint"
    ).select(
        F.to_date("day").alias("sale_date"), F.lit(None).cast("timestamp").alias("last_processed_ts"),
        F.col("n").alias("total_orders"),
        *(F.lit(0).cast(SUMMARY[c].dataType).alias(c) for c in SUMMARY.fieldNames()[3:8]),
    )


def put(spark, path, tmp_path, fresh, days):
    pending = str(tmp_path / "days")
    spark.createDataFrame([(d,) for d in days], "d string").selectExpr("to_date(d) AS sale_date").write.mode(
        "overwrite").parquet(pending)
    tables.replace_days(spark, path, fresh, spark.read.parquet(pending), "sale_date", SUMMARY)
    return {str(r.sale_date): r.total_orders for r in tables.read_days(spark, path, SUMMARY).collect()}


def test_days_are_replaced_kept_and_emptied(spark, tmp_path):
    path = str(tmp_path / "summary")
    days = ["2024-01-01", "2024-01-02", "2024-02-01", "2025-01-01"]
    fresh = summary_rows(spark, d2024_01_01=1, d2024_01_02=2, d2024_02_01=3, d2025_01_01=4)
    assert put(spark, path, tmp_path, fresh, days) == dict(zip(days, (1, 2, 3, 4)))
    # One day of a month changes, the only day of another loses its last order.
    fresh = summary_rows(spark, d2024_01_02=9)
    got = put(spark, path, tmp_path, fresh, ["2024-01-02", "2024-02-01"])
    assert got == {"2024-01-01": 1, "2024-01-02": 9, "2025-01-01": 4}
    # An emptied day can fill again.
    fresh = summary_rows(spark, d2024_02_01=5)
    assert put(spark, path, tmp_path, fresh, ["2024-02-01"])["2024-02-01"] == 5
    assert len(list(Path(path).glob("sale_month=*"))) == 3


def test_expiry_drops_months_and_cuts_one(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.sql("SELECT explode(sequence(DATE'2023-11-01', DATE'2024-02-10')) AS d")
    tables.overwrite(tables.with_month(days, "d"), path, tables.MONTH)
    tables.expire_before(spark, path, "2024-01-20", "d")
    kept = spark.read.parquet(path)
    assert kept.agg(F.min("d"), F.count("*")).first()[:] == (kept.agg(F.min("d")).first()[0], 22)
    assert str(kept.agg(F.min("d")).first()[0]) == "2024-01-20"
    tables.expire_before(spark, path, "2024-03-01", "d")
    assert not list(Path(path).glob("sale_month=*"))


def row_groups(path, keep):
    """Row groups of all files, and those whose statistics let ``keep`` hold."""
    every = kept = 0
    for file in Path(path).glob("**/*.parquet"):
        part = pq.ParquetFile(file).metadata
        names = [part.schema.column(i).name for i in range(part.num_columns)]
        for g in range(part.num_row_groups):
            group = part.row_group(g)
            bounds = {n: group.column(i).statistics for i, n in enumerate(names)}
            every += 1
            kept += keep(bounds)
    return every, kept


def share_read(path, order, day):
    groups, by_order = row_groups(path, lambda b: b["order_id"].min <= order <= b["order_id"].max)
    _, by_day = row_groups(path, lambda b: b["created_at"].min.date() <= day <= b["created_at"].max.date())
    return groups, by_order / groups, by_day / groups


def test_z_order_prunes_by_day_and_by_order(spark, tmp_path):
    """Against a sort by day and order, which lets readers skip by the day only."""
    items = shop.order_items(spark, "/root/testdata/sf0.01")
    order, day = items.where("order_id > '4'").orderBy("order_item_id").select(
        "order_id", F.to_date("created_at")).first()
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "plain")
    zorder.write_z_ordered(items, curve, "created_at", "order_id", 64)
    items.repartitionByRange(64, "created_at", "order_id").sortWithinPartitions(
        "created_at", "order_id").write.parquet(plain)
    groups, by_order, by_day = share_read(curve, order, day)
    assert groups == 64 and by_order <= 0.25 and by_day <= 0.25
    groups, by_order, by_day = share_read(plain, order, day)
    assert groups == 64 and by_order > 0.9 and by_day < 0.05
    rows = spark.read.parquet(curve)
    assert rows.count() == items.count() and rows.exceptAll(items).isEmpty()


def test_z_order_keeps_rows_without_a_day_or_key(spark, tmp_path):
    rows = spark.createDataFrame(
        [(None, None), ("1", None), (None, "2024-01-01"), ("é", "2024-01-02"), ("", "1900-01-01")],
        "order_id string, day string").withColumn("day", F.to_date("day"))
    for number, some in enumerate((rows, rows.limit(0))):
        zorder.write_z_ordered(some, str(tmp_path / str(number)), "day", "order_id", 3)
        back = spark.read.schema(rows.schema).parquet(str(tmp_path / str(number)))
        assert sorted(map(str, back.collect())) == sorted(map(str, some.collect()))


def test_a_cell_is_the_number_of_lines_reached_and_needs_no_list(spark):
    lines = [5, 5, -3, 9, 20]
    values = [None, -4, -3, 4, 5, 8, 9, 19, 20, 21]
    cell = zorder._cell(F.col("n"), lines)
    found = spark.createDataFrame([(v,) for v in values], "n long").select("n", cell.alias("c"))
    assert {r.n: r.c for r in found.collect()} == {
        v: sum(v is not None and x <= v for x in set(lines)) for v in values}
    assert spark.range(1).select(zorder._cell(F.col("id"), [])).first()[0] == 0
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_numbered_in_their_order(spark):
    texts = ["", "1", "10", "100", "2", "9", "a", "ab", "b", "é", "字"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    numbers = {r.t: r.n for r in rows.select("t", zorder.text_number("t").alias("n")).collect()}
    assert sorted(texts, key=numbers.get) == sorted(texts, key=lambda t: t.encode())


def test_columns_with_few_values_are_dictionary_coded(spark, sf_dir, tmp_path):
    """Status and topic, in every file of the stored orders and of a landed feed."""
    tables.append_sorted(shop.orders(spark, sf_dir), str(tmp_path / "orders"), ORDERS)
    tables.overwrite(shop.change_feed(spark, sf_dir), str(tmp_path / "feed"))
    for folder, column in (("orders", "status"), ("feed", "topic")):
        files = list((tmp_path / folder).glob("**/*.parquet"))
        assert files
        for file in files:
            part = pq.ParquetFile(file).metadata
            if part.num_rows < 16:  # a dictionary would not pay
                continue
            index = [part.schema.column(i).name for i in range(part.num_columns)].index(column)
            for g in range(part.num_row_groups):
                chunk = part.row_group(g).column(index)
                assert chunk.has_dictionary_page
                assert any(e.endswith("_DICTIONARY") for e in chunk.encodings)


def test_what_was_shuffled_is_let_go_once_it_is_written(spark, tmp_path, monkeypatch):
    def shuffled():
        disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = disk.getAllFiles().mkString(" ").split()
        return {n.rpartition("/")[2] for n in names if "shuffle_" in n and n.endswith(".data")}

    monkeypatch.setattr(session, "LET_GO_EVERY", 0.0)
    spark._jvm.java.lang.System.gc()
    time.sleep(1)
    before = shuffled()
    tables.overwrite(spark.range(1000).repartition(3, "id"), str(tmp_path / "rows"))
    for _ in range(50):
        if not shuffled() - before:
            return
        time.sleep(0.1)
    raise AssertionError(shuffled() - before)
