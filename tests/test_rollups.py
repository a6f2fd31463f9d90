"""Roll-ups from stored rows, tables stored by order, copies compared by digests."""

from __future__ import annotations

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from tests.rows import items, metrics
from tidemark.operators import checks, rollup
from tidemark.operators.sales import DAY, TIMESTAMP, sales_metrics
from tidemark.plans.colocated import ColocatedSales
from tidemark.plans.rollups import SalesRollups
from tidemark.schemas import ORDERS
from tidemark.sources import shop

BOUGHT = [
    ("A", 1, "10.00", "7.00", "2024-01-01 01:00:00"), ("A", 2, "10.00", "7.00", "2024-01-07 01:00:00"),
    ("B", 4, "1.00", "0.50", "2024-01-07 01:00:00"), ("C", 9, "1.00", "0.50", "2024-01-07 02:00:00"),
    ("A", 1, "3.00", "2.00", "2024-02-01 01:00:00"), ("B", 1, "3.00", "2.00", "2024-01-08 01:00:00"),
]
PLACED = [("A", "Completed"), ("B", "Completed"), ("C", "Pending"), ("D", "Completed")]


def placed(spark):
    return spark.createDataFrame(
        [(o, s, f"2024-01-0{1 + i} 00:00:00") for i, (o, s) in enumerate(PLACED)],
        "order_id string, status string, created_at string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp"))


@pytest.mark.parametrize("grain", [DAY, TIMESTAMP])
def test_orders_of_a_period_are_counted_once(spark, tmp_path, grain):
    stored = SalesRollups(str(tmp_path))
    stored.number_orders(spark, placed(spark), "one")
    stored.store(spark, items(spark, *BOUGHT), placed(spark), grain)

    def counted(unit):
        found = stored.roll_up(spark, grain, unit, "sale_date")
        return {d: m[:3] for d, m in metrics(found).items()}

    assert counted("day") == {
        "2024-01-01": (1, 1, "10.00"), "2024-01-07": (2, 6, "24.00"), "2024-01-08": (1, 1, "3.00"),
        "2024-02-01": (1, 1, "3.00")}
    assert counted("week") == {
        "2024-01-01": (2, 7, "34.00"), "2024-01-08": (1, 1, "3.00"), "2024-01-29": (1, 1, "3.00")}
    assert counted("month") == {"2024-01-01": (2, 8, "37.00"), "2024-02-01": (1, 1, "3.00")}
    assert counted("year") == {"2024-01-01": (2, 9, "40.00")}


def test_numbers_are_dense_follow_time_and_stay(spark, sf_dir, tmp_path):
    stored = SalesRollups(str(tmp_path))
    every = shop.orders(spark, sf_dir)
    stored.number_orders(spark, every.where("created_at < '1996-01-01'"), "one")
    first = {r.order_id: r.order_no for r in stored.numbers(spark).collect()}
    for load in ("two", "two", "one"):
        stored.number_orders(spark, every, load)
    numbers = {r.order_id: r.order_no for r in stored.numbers(spark).collect()}
    assert sorted(numbers.values()) == list(range(1, every.count() + 1))
    assert first.items() <= numbers.items() and len(first) > 100
    placed_at = {r.order_id: r.created_at for r in every.collect()}
    for some in (first, {o: n for o, n in numbers.items() if o not in first}):
        in_order = sorted(some, key=some.get)
        assert in_order == sorted(some, key=lambda o: (placed_at[o], o))


def test_roll_ups_take_no_item(spark, tmp_path):
    """The items' files are broken once the days are stored."""
    path = tmp_path / "items"
    items(spark, *BOUGHT).write.parquet(str(path))
    stored = SalesRollups(str(tmp_path / "rollups"))
    stored.number_orders(spark, placed(spark), "one")
    for grain in (DAY, TIMESTAMP):
        stored.store(spark, spark.read.parquet(str(path)), placed(spark), grain)
    for file in path.glob("*.parquet"):
        file.write_bytes(b"broken")
    assert stored.roll_up(spark, DAY, "month", "m").count() == 2
    assert stored.roll_up(spark, TIMESTAMP, "day", "d").count() == 4


def test_numbers_beyond_one_chunk(spark, tmp_path):
    """Orders spread over several bitmaps of a day, and a day's list does not grow with them."""
    many = spark.range(100_000).selectExpr(
        "CAST(id AS STRING) AS order_id", "'Completed' AS status",
        "TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, 0, id) AS created_at")
    bought = many.crossJoin(spark.range(2)).selectExpr(
        "order_id", "1L AS quantity", "CAST(1 AS DECIMAL(10,2)) AS price",
        "CAST(1 AS DECIMAL(10,2)) AS cost_price", "created_at + make_dt_interval(id) AS kafka_ts")
    stored = SalesRollups(str(tmp_path))
    stored.number_orders(spark, many, "one")
    stored.store(spark, bought, many, DAY)
    assert stored.rows(spark, DAY).agg(F.max(F.length("orders"))).first()[0] == 4096
    (year,) = stored.roll_up(spark, DAY, "year", "y").collect()
    assert (year.total_orders, year.total_items_sold) == (100_000, 200_000)


def plan_lines(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    return text.splitlines()


def depth(line):
    return len(re.match(r"[\s:+\-*()0-9]*", line).group())


def test_colocated_tables_join_without_a_shuffle(spark, sf_dir, tmp_path):
    stored = ColocatedSales(str(tmp_path), f"t_{tmp_path.name.replace('-', '_')}"[-40:], 4)
    bought, every = shop.order_items(spark, sf_dir), shop.orders(spark, sf_dir)
    stored.store(spark, bought, every)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = stored.metrics(spark)
        lines = plan_lines(found)
        joins = [i for i, x in enumerate(lines) if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
        assert len(joins) == 1
        below = []
        for line in lines[joins[0] + 1 :]:
            if depth(line) <= depth(lines[joins[0]]):
                break
            below.append(line)
        assert below and not [x for x in below if "Exchange" in x]
        assert metrics(found) == metrics(sales_metrics(bought, every))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_buckets_grow_with_the_items(spark, sf_dir, tmp_path):
    name = f"g_{tmp_path.name.replace('-', '_')}"[-40:]
    stored = ColocatedSales(str(tmp_path), name, 2, bucket_items=1000)
    items, orders = shop.order_items(spark, sf_dir), shop.orders(spark, sf_dir)
    stored.store(spark, items, orders)
    files = {re.search(r"_(\d{5})\.", f.name)[1] for f in (tmp_path / "items").glob("*.parquet")}
    assert len(files) == -(-items.count() // 1000)
    assert metrics(stored.metrics(spark)) == metrics(sales_metrics(items, orders))


def test_bitmaps_are_made_where_their_rows_have_met(spark):
    sold = spark.createDataFrame(
        [("2024-01-01", n, 1, 10, 5) for n in range(1, 51)],
        "sale_date string, order_no long, pieces long, revenue_c long, cost_c long")
    rows = rollup.bitmap_rows(sold, "sale_date")
    assert [r.pieces for r in rows.collect()] == [50]
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    prepared = rows._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan
    exchanges = [line for line in prepared.split("Initial Plan")[-1].splitlines() if "Exchange" in line]
    assert exchanges and not any("ENSURE_REQUIREMENTS" in line for line in exchanges)


def test_a_hot_order_is_not_in_a_bucket(spark, tmp_path):
    bought = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS order_id", "1L AS quantity",
        "CAST(1 AS DECIMAL(10,2)) AS price", "CAST(1 AS DECIMAL(10,2)) AS cost_price",
        "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 5 AS INT)) AS kafka_ts")
    every = bought.select("order_id").distinct().selectExpr(
        "order_id", "IF(order_id = '1', 'Pending', 'Completed') AS status")
    stored = ColocatedSales(str(tmp_path), f"h_{tmp_path.name.replace('-', '_')}"[-40:], 4)
    stored.store(spark, bought, every)
    assert [r.order_id for r in stored.hot_orders(spark).collect()] == ["hot"]
    assert spark.table(f"{stored.name}_items").where("order_id = 'hot'").isEmpty()
    assert len(list(pathlib.Path(tmp_path).glob("items/*.parquet"))) == 4
    assert metrics(stored.metrics(spark)) == metrics(sales_metrics(bought, every))


COLUMNS = [c for c in ORDERS.columns if c != "order_id"]


def test_digests_find_what_the_join_of_all_rows_finds(spark, sf_dir, tmp_path):
    left = shop.orders(spark, sf_dir)
    right = left.where("order_id % 211 <> 3").withColumn(
        "status", F.expr("IF(order_id % 307 = 5, NULL, status)")).unionByName(
        left.where("order_id = 8").withColumn("order_id", F.lit("new")))
    want = sorted(map(tuple, checks.reconcile(left, right, "order_id", COLUMNS).collect()))
    for levels in ((10, 20), (2,), (3, 6, 9)):
        found = checks.reconcile_by_digests(
            left, right, "order_id", COLUMNS, str(tmp_path / "-".join(map(str, levels))), levels)
        assert sorted(map(tuple, found.collect())) == want
    assert {v for _, v, _ in want} == {"only_left", "only_right", "differs"}


def test_a_value_that_moves_to_another_column_differs(spark, tmp_path):
    schema = "order_id string, a string, b string"
    left = spark.createDataFrame([("1", None, "x"), ("2", "x", None)], schema)
    right = spark.createDataFrame([("1", "x", None), ("2", "x", None)], schema)
    found = checks.reconcile_by_digests(left, right, "order_id", ["a", "b"], str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("1", "differs", "a,b")]


def test_equal_copies_send_one_row_a_range(spark, sf_dir, tmp_path):
    left = shop.orders(spark, sf_dir).repartition(3)
    right = shop.orders(spark, sf_dir).repartition(2)
    found = checks.reconcile_by_digests(left, right, "order_id", COLUMNS, str(tmp_path), (4, 20))
    assert found.isEmpty()
    assert spark.read.parquet(str(tmp_path / "differing-4")).isEmpty()
    hashed = checks._hashed(left, "order_id", COLUMNS)
    assert checks.range_digests(hashed, 4).count() <= 16
