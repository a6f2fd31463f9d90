from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from tests.rows import at, metrics
from tidemark.operators.sales import sales_metrics
from tidemark.plans import arrival_index
from tidemark.plans.arrival_index import ARRIVAL_MONTH, ArrivalIndex, by_arrival
from tidemark.plans.incremental import (
    SUMMARY,
    current,
    high_water_mark,
    new_rows_only,
    run_incremental,
    summary,
)
from tidemark.schemas import ORDER_ITEMS, ORDERS
from tidemark.sinks.tables import MONTH

FIRST = "2000-01-01 00:00:00"


class Warehouse:
    """Append-only stored tables, filled step by step."""

    def __init__(self, spark, root):
        self.spark, self.root, self.runs, self.offset = spark, root, 0, 0

    def add(self, orders=(), items=()):
        """orders: (id, status, ts[, op]); items: (id, order, quantity, ts[, op])"""
        self._append("orders", [(o[3] if len(o) > 3 else "u", o[0], o[1], at(o[2])) for o in orders],
                     "op string, order_id string, status string, kafka_ts timestamp")
        self._append(
            "items", [(i[4] if len(i) > 4 else "u", i[0], i[1], i[2], at(i[3])) for i in items],
            "op string, order_item_id string, order_id string, quantity bigint, kafka_ts timestamp",
            price="CAST(10 AS DECIMAL(10,2))", cost_price="CAST(7 AS DECIMAL(10,2))",
        )

    def _append(self, name, rows, schema, **constants):
        rows = [(*r, self._next()) for r in rows]
        df = self.spark.createDataFrame(rows, f"{schema}, offset bigint")
        df = df.selectExpr("*", *(f"{sql} AS {c}" for c, sql in constants.items()))
        df.coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def _next(self):
        self.offset += 1
        return self.offset

    def table(self, name):
        return self.spark.read.parquet(f"{self.root}/{name}")

    def run(self):
        self.runs += 1
        run_incremental(
            self.spark, self.table("items"), self.table("orders"),
            f"{self.root}/summary", f"{self.root}/days-{self.runs}", FIRST,
        )
        got = metrics(summary(self.spark, f"{self.root}/summary"))
        full = metrics(sales_metrics(
            current(self.table("items"), ORDER_ITEMS.key), current(self.table("orders"), ORDERS.key)
        ))
        assert got == full
        return {day: m[:2] for day, m in got.items()}


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path))


def test_runs_within_a_day_and_repeated_runs(warehouse):
    warehouse.add([("A", "Completed", "2024-01-01 01:00")], [("I1", "A", 1, "2024-01-01 02:00")])
    assert warehouse.run() == {"2024-01-01": (1, 1)}
    warehouse.add([("B", "Completed", "2024-01-01 03:00")],
                  [("I2", "A", 2, "2024-01-01 04:00"), ("I3", "B", 4, "2024-01-01 04:00")])
    assert warehouse.run() == {"2024-01-01": (2, 7)}
    assert warehouse.run() == {"2024-01-01": (2, 7)}


def test_order_completed_after_its_items_arrived(warehouse):
    warehouse.add([("A", "Pending", "2024-01-01 01:00"), ("B", "Completed", "2024-01-05 01:00")],
                  [("I1", "A", 1, "2024-01-01 02:00"), ("I2", "B", 1, "2024-01-05 02:00")])
    assert warehouse.run() == {"2024-01-05": (1, 1)}
    warehouse.add([("A", "Completed", "2024-01-06 00:00")])
    assert warehouse.run() == {"2024-01-01": (1, 1), "2024-01-05": (1, 1)}


def test_cancelled_order_empties_its_day(warehouse):
    warehouse.add([("A", "Completed", "2024-01-01 01:00"), ("B", "Completed", "2024-02-01 01:00")],
                  [("I1", "A", 1, "2024-01-01 02:00"), ("I2", "B", 1, "2024-02-01 02:00")])
    warehouse.run()
    warehouse.add([("A", "Cancelled", "2024-02-02 00:00")])
    assert warehouse.run() == {"2024-02-01": (1, 1)}
    warehouse.add([("B", None, "2024-02-03 00:00", "d")])
    assert warehouse.run() == {}


def test_item_update_moves_it_to_another_day(warehouse):
    warehouse.add([("A", "Completed", "2024-01-01 01:00")],
                  [("I1", "A", 1, "2024-01-01 02:00"), ("I2", "A", 1, "2024-01-01 02:00")])
    warehouse.run()
    warehouse.add(items=[("I1", "A", 5, "2024-01-03 00:00")])
    assert warehouse.run() == {"2024-01-01": (1, 1), "2024-01-03": (1, 5)}
    warehouse.add(items=[("I2", None, None, "2024-01-04 00:00", "d")])
    assert warehouse.run() == {"2024-01-03": (1, 5)}


def test_row_with_the_marks_own_timestamp_is_not_missed(warehouse):
    warehouse.add([("A", "Completed", "2024-01-01 00:00")], [("I1", "A", 1, "2024-01-01 02:00:00.500")])
    warehouse.run()
    warehouse.add(items=[("I2", "A", 1, "2024-01-01 02:00:00.500")])
    assert warehouse.run() == {"2024-01-01": (1, 2)}


def test_mark_of_an_empty_summary_is_the_first_one(spark):
    empty = spark.createDataFrame([], SUMMARY)
    assert high_water_mark(empty).first()[0] == at("2024-01-01 00:00:00")


def test_rows_at_the_mark_are_old(spark):
    from tests.rows import items, orders

    bought = items(spark, ("A", 1, "1.00", "1.00", "2024-01-01 00:00:00"),
                   ("A", 2, "1.00", "1.00", "2024-01-01 00:00:00.001"))
    got = metrics(new_rows_only(bought, orders(spark, ("A", "Completed")), "2024-01-01 00:00:00"))
    assert got["2024-01-01"][1] == 2


def test_failure_is_raised(spark, tmp_path):
    broken = spark.sql("SELECT 'x' AS order_id")
    with pytest.raises(Exception):
        run_incremental(spark, broken, broken, str(tmp_path / "s"), str(tmp_path / "w"))


def month_files(root, *parts):
    return [p for part in parts for p in pathlib.Path(root).glob(f"{part}/**/*.parquet")]


def test_a_run_reads_only_the_months_and_buckets_of_what_changed(spark, tmp_path):
    """After the first run every file that the second has no use for is broken."""
    root, schemas = str(tmp_path), {}

    def add(name, rows, schema, **constants):
        df = spark.createDataFrame(rows, schema).selectExpr(
            "*", *(f"{sql} AS {c}" for c, sql in constants.items()))
        by_arrival(df).write.mode("append").partitionBy(ARRIVAL_MONTH).parquet(f"{root}/{name}")

    def add_orders(*rows):
        add("orders", [("u", o, s, at(ts), n) for o, s, ts, n in rows],
            "op string, order_id string, status string, kafka_ts timestamp, offset bigint")

    def add_items(*rows):
        add("items", [("u", i, o, q, at(ts), n) for i, o, q, ts, n in rows],
            "op string, order_item_id string, order_id string, quantity bigint, kafka_ts timestamp, offset bigint",
            price="CAST(10 AS DECIMAL(10,2))", cost_price="CAST(7 AS DECIMAL(10,2))")

    def table(name):
        if name not in schemas:
            schemas[name] = spark.read.parquet(f"{root}/{name}").schema
        return spark.read.schema(schemas[name]).parquet(f"{root}/{name}")

    def run(number):
        run_incremental(spark, table("items"), table("orders"), f"{root}/summary",
                        f"{root}/work-{number}", FIRST, buckets=32)
        rows = spark.read.schema(SUMMARY).parquet(f"{root}/summary").where(f"{MONTH} = 202406")
        return {d: m[:2] for d, m in metrics(rows.where("total_orders > 0")).items()}

    add_orders(*[(f"O{i}", "Completed", f"2024-{1 + i % 6:02d}-01 01:00", i) for i in range(24)])
    add_items(*[(f"I{i}", f"O{i}", 1, f"2024-{1 + i % 6:02d}-02 02:00", 100 + i) for i in range(24)])
    assert run(1) == {"2024-06-02": (4, 4)}
    add_orders(("N", "Completed", "2024-06-20 01:00", 500))
    add_items(("J", "N", 5, "2024-06-20 02:00", 501), ("I5", "O5", 3, "2024-06-21 02:00", 502))
    kept, broken = f"{ARRIVAL_MONTH}=202406", 0
    for file in month_files(root, "items", "orders"):
        if file.parent.name != kept:
            file.write_bytes(b"broken")
            broken += 1
    buckets = {p.parent.name for p in month_files(root, "summary_index/versions")}

    def bucket(key):
        row = spark.createDataFrame([(key,)]).select(F.pmod(F.xxhash64("*"), F.lit(32)))
        return f"bucket={row.first()[0]}"

    # O5, I5 changed; J and N are new. The mark's own rows are looked at once more.
    again = [f"I{i}" for i in range(5, 24, 6)]
    used = {bucket(k) for k in ("J", *again)}
    assert len(buckets - used) > 5
    for file in month_files(root, "summary_index/versions"):
        if file.parent.name not in used:
            file.write_bytes(b"broken")
            broken += 1
    assert broken > 12
    assert run(2) == {"2024-06-02": (3, 3), "2024-06-20": (1, 5), "2024-06-21": (1, 3)}


def test_index_takes_the_same_rows_again(warehouse):
    warehouse.add([("A", "Completed", "2024-01-01 01:00")],
                  [("I1", "A", 1, "2024-01-01 02:00"), ("I1", "A", 2, "2024-01-02 02:00")])
    warehouse.run()
    index = ArrivalIndex(f"{warehouse.root}/summary_index")
    spark = warehouse.spark
    before = {n: index.read(spark, n).count() for n in ("versions", "order_days", "statuses", "superseded")}
    assert before == {"versions": 2, "order_days": 2, "statuses": 1, "superseded": 1}
    index.take_in(spark, warehouse.table("items"), warehouse.table("orders"))
    assert before == {n: index.read(spark, n).count() for n in before}
    assert warehouse.run() == {"2024-01-02": (1, 2)}


def test_rows_are_moved_into_the_index_once(warehouse, monkeypatch):
    """What is stored in buckets has met what is new by one exchange, and is written where it is."""
    plans, write = {}, arrival_index.overwrite_partitions

    def recorded(rows, path, *partitions):
        plans[path.rpartition("/")[2]] = rows._jdf.queryExecution().executedPlan().toString()
        write(rows, path, *partitions)

    monkeypatch.setattr(arrival_index, "overwrite_partitions", recorded)
    warehouse.add([("A", "Completed", "2024-01-01 01:00")], [("I1", "A", 1, "2024-01-01 02:00")])
    assert warehouse.run() == {"2024-01-01": (1, 1)}
    warehouse.add([("A", "Completed", "2024-01-02 01:00")], [("I1", "A", 4, "2024-02-02 02:00")])
    assert warehouse.run() == {"2024-02-02": (1, 4)}
    for name in ("versions", "order_days", "statuses"):
        assert plans[name].count("Exchange ") == 1


def test_live_items_are_moved_once(warehouse):
    """Replaced versions meet the items in the aggregate that finds each item's last one."""
    spark = warehouse.spark
    warehouse.add([("A", "Completed", "2024-01-01 01:00")], [
        ("I1", "A", 1, "2024-01-01 02:00"), ("I1", "A", 2, "2024-01-02 02:00"),
        ("I2", "A", 3, "2024-01-01 02:00"), ("I2", "A", 4, "2024-02-02 02:00"),
        ("I3", "A", 5, "2024-01-01 02:00"), ("I3", "A", 6, "2024-01-03 02:00", "d"),
        ("I4", "A", 7, "2024-01-01 02:00")])
    warehouse.run()
    days = spark.createDataFrame([(at(f"2024-01-0{d} 00:00").date(),) for d in (1, 2, 3)], "sale_date date")
    index = ArrivalIndex(f"{warehouse.root}/summary_index")
    live = index.live_items(spark, warehouse.table("items"), days)
    assert {(r.order_item_id, r.quantity) for r in live.collect()} == {("I1", 2), ("I4", 7)}
    plan = index.live_items(spark, warehouse.table("items"), days)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(order_item_id") == 1 and "LeftAnti" not in plan


def test_a_run_that_failed_after_the_index_was_written(warehouse, monkeypatch):
    from tidemark.plans import incremental

    def fail(*args):
        raise RuntimeError("driver lost")

    warehouse.add([("A", "Completed", "2024-01-01 01:00")], [("I1", "A", 1, "2024-01-01 02:00")])
    warehouse.run()
    warehouse.add(items=[("I1", "A", 4, "2024-01-02 02:00"), ("I2", "A", 1, "2024-01-02 03:00")])
    monkeypatch.setattr(incremental, "replace_days", fail)
    with pytest.raises(RuntimeError):
        warehouse.run()
    monkeypatch.undo()
    assert warehouse.run() == {"2024-01-02": (1, 5)}
