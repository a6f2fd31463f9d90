from __future__ import annotations

import json
import pathlib
from decimal import Decimal

import pytest

from tests.rows import at
from tidemark.operators.upserts import (
    insert_if_absent,
    keyed_upsert,
    one_row_per_key,
    with_defaults,
)
from tidemark.catalog import queries
from tidemark.plans import ingest
from tidemark.plans.ingest import create_table, ingest_day, source_table
from tidemark.schemas import ORDER_ITEMS, ORDERS, PRODUCTS
from tidemark.sinks import versions
from tidemark.sinks.versions import RefusedLoad, VersionedTables
from tidemark.sources.extracts import read_extract, rows_of_day, typed
from tidemark.sources.seed import seed_products


def order_rows(spark, *rows):
    """(order_id, customer_id, status, total_amount, created_at, updated_at)"""
    return spark.createDataFrame(
        [(o, c, s, a and Decimal(a), f and at(f), u and at(u)) for o, c, s, a, f, u in rows],
        ORDERS.schema,
    )


def as_dict(df):
    return {r.order_id: (r.customer_id, r.status, str(r.total_amount), str(r.created_at)[:10]) for r in df.collect()}


def test_known_orders_keep_customer_and_creation(spark):
    target = order_rows(
        spark,
        ("A", "C1", "Pending", "1.00", "2024-01-01", "2024-01-01"),
        ("B", "C2", "Pending", "2.00", "2024-01-01", "2024-01-01"),
    )
    incoming = order_rows(
        spark,
        ("A", "C9", "Completed", "1.50", "2024-02-02", "2024-02-02"),
        ("N", "C3", "Pending", "3.00", "2024-02-02", "2024-02-02"),
    )
    assert as_dict(keyed_upsert(target, incoming, ORDERS)) == {
        "A": ("C1", "Completed", "1.50", "2024-01-01"),
        "B": ("C2", "Pending", "2.00", "2024-01-01"),
        "N": ("C3", "Pending", "3.00", "2024-02-02"),
    }


def test_one_extract_may_hold_a_key_twice(spark):
    incoming = order_rows(
        spark,
        ("A", "C2", "Completed", "2.00", "2024-01-02", "2024-01-03"),
        ("A", "C1", "Pending", "1.00", "2024-01-01", "2024-01-02"),
    )
    assert as_dict(one_row_per_key(incoming, ORDERS)) == {"A": ("C1", "Completed", "2.00", "2024-01-01")}


def test_empty_columns_get_their_defaults(spark):
    row = with_defaults(order_rows(spark, ("A", "C", "Pending", None, None, None)), ORDERS).first()
    assert str(row.total_amount) == "0.00" and row.created_at is not None
    assert row.created_at == row.updated_at


def test_insert_if_absent_keeps_known_rows(spark):
    known = spark.createDataFrame([(1, "old")], "id int, name string")
    offered = spark.createDataFrame([(1, "new"), (2, "new")], "id int, name string")
    assert sorted(map(tuple, insert_if_absent(known, offered, "id").collect())) == [(1, "old"), (2, "new")]


def test_seed_products(spark):
    seed = seed_products(spark)
    assert seed.dtypes == spark.createDataFrame([], PRODUCTS.schema).dtypes and seed.count() == 10
    row = seed.where("product_id = 'PROD-107'").first()
    assert (row.product_name, str(row.cost_price)) == ("Magnesium", "7.90")


ORDERS_CSV = """order_id,customer_id,status,total_amount,created_at,updated_at
A,C1,Pending,45.7,2024-12-03 10:00:00,2024-12-03 10:00:00
A,C1,Completed,45.7,2024-12-03 10:00:00,2024-12-04 09:00:00
B,C2,Pending,31.91,2024-12-04 08:00:00,2024-12-04 08:00:00
"""
ITEMS_CSV = """order_item_id,order_id,product_id,quantity,price,cost_price,created_at,updated_at
I1,A,PROD-1,2,22.85,10.00,2024-12-03 10:00:00,2024-12-04 09:00:00
I2,B,PROD-2,1,31.91,22.34,2024-12-04 08:00:00,2024-12-04 08:00:00
"""


@pytest.fixture
def extracts(tmp_path):
    paths = []
    for name, text in (("orders", ORDERS_CSV), ("items", ITEMS_CSV)):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        paths.append(str(path))
    return paths


def test_extract_is_read_by_name_and_cast_exactly(spark, extracts):
    rows = typed(rows_of_day(read_extract(spark, extracts[0], ORDERS), "2024-12-04"), ORDERS)
    assert rows.schema == ORDERS.schema
    assert as_dict(rows) == {
        "A": ("C1", "Completed", "45.70", "2024-12-03"), "B": ("C2", "Pending", "31.91", "2024-12-04"),
    }


def test_extract_with_other_columns_fails(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(ORDERS_CSV.replace("customer_id,status", "status,customer_id"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_extract(spark, str(path), ORDERS).collect()


def test_days_are_loaded_one_by_one_and_again(spark, extracts, tmp_path):
    root = str(tmp_path / "shop")
    ingest_day(spark, root, "2024-12-03", *extracts, buckets=2)
    assert as_dict(source_table(spark, root, ORDERS)) == {"A": ("C1", "Pending", "45.70", "2024-12-03")}
    assert source_table(spark, root, ORDER_ITEMS).isEmpty()
    for _ in range(2):
        ingest_day(spark, root, "2024-12-04", *extracts, buckets=2)
        assert as_dict(source_table(spark, root, ORDERS)) == {
            "A": ("C1", "Completed", "45.70", "2024-12-03"), "B": ("C2", "Pending", "31.91", "2024-12-04"),
        }
        assert source_table(spark, root, ORDER_ITEMS).count() == 2
    VersionedTables(root).vacuum(spark)
    assert len(list((tmp_path / "shop" / "_pointers").glob("0*"))) == 1
    assert source_table(spark, root, ORDERS).count() == 2


def test_an_extract_is_read_once_a_load(spark, extracts, tmp_path, monkeypatch):
    from tidemark.plans import ingest

    orders, items = extracts
    root, read = str(tmp_path / "tables"), []
    create_table(order_rows(spark), root, ORDERS, 2)
    create_table(spark.createDataFrame([], ORDER_ITEMS.schema), root, ORDER_ITEMS, 2)
    whole = ingest.upserted_buckets

    def watched(spark, root, incoming, *more):
        read.extend(incoming.inputFiles())
        return whole(spark, root, incoming, *more)

    monkeypatch.setattr(ingest, "upserted_buckets", watched)
    ingest_day(spark, root, "2024-12-04", orders, items)
    assert read and not any(".csv" in file for file in read)


def test_failed_load_leaves_both_tables_alone(spark, extracts, tmp_path):
    root = str(tmp_path / "shop")
    create_table(order_rows(spark, ("A", "C1", "Pending", "1.00", "2024-01-01", "2024-01-01")), root, ORDERS, 2)
    with open(extracts[1], "a") as items:
        items.write("I3,B,PROD-2,many,31.91,22.34,2024-12-04 08:00:00,2024-12-04 08:00:00\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest_day(spark, root, "2024-12-04", *extracts, buckets=2)
    assert as_dict(source_table(spark, root, ORDERS)) == {"A": ("C1", "Pending", "1.00", "2024-01-01")}
    assert source_table(spark, root, ORDER_ITEMS).isEmpty()


def test_readers_see_both_tables_before_or_after_a_load(spark, extracts, tmp_path, monkeypatch):
    """A reader looks between the writes of the two tables, and another keeps its pointer."""
    root = str(tmp_path / "shop")
    ingest_day(spark, root, "2024-12-03", *extracts, buckets=2)
    before = as_dict(source_table(spark, root, ORDERS))
    held = VersionedTables(root).pointer(spark)
    written, seen = versions.overwrite, []

    def write_and_look(rows, path, *partitions):
        written(rows, path, *partitions)
        seen.append((as_dict(source_table(spark, root, ORDERS)),
                     source_table(spark, root, ORDER_ITEMS).count()))

    monkeypatch.setattr(versions, "overwrite", write_and_look)
    ingest_day(spark, root, "2024-12-04", *extracts)
    assert seen == [(before, 0)] * 2
    assert source_table(spark, root, ORDERS).count() == source_table(spark, root, ORDER_ITEMS).count() == 2
    assert as_dict(source_table(spark, root, ORDERS, held)) == before


def test_interrupted_load_is_not_seen_and_can_run_again(spark, extracts, tmp_path, monkeypatch):
    root = str(tmp_path / "shop")

    def fail(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(VersionedTables, "_point", fail)
    with pytest.raises(RuntimeError):
        ingest_day(spark, root, "2024-12-04", *extracts, buckets=2)
    monkeypatch.undo()
    assert source_table(spark, root, ORDERS).isEmpty()
    assert source_table(spark, root, ORDER_ITEMS).isEmpty()
    counted = ingest_day(spark, root, "2024-12-04", *extracts, buckets=2)
    assert counted["orders"]["rows"] == counted["order_items"]["rows"] == 2
    assert source_table(spark, root, ORDERS).count() == source_table(spark, root, ORDER_ITEMS).count() == 2


def test_load_that_breaks_its_checks_is_refused(spark, extracts, tmp_path):
    root = str(tmp_path / "shop")
    ingest_day(spark, root, "2024-12-03", *extracts, buckets=2)
    with open(extracts[0], "a") as orders:
        orders.write("C,C3,Lost,1.00,2024-12-04 08:00:00,2024-12-04 08:00:00\n")
    with pytest.raises(RefusedLoad) as refused:
        ingest_day(spark, root, "2024-12-04", *extracts)
    assert refused.value.report["orders"] == {"not allowed status": 1}
    assert list(as_dict(source_table(spark, root, ORDERS))) == ["A"]
    VersionedTables(root).vacuum(spark)
    assert [p.name[:3] for p in (tmp_path / "shop" / "_data").iterdir()] == ["day"]


def test_checks_count_what_the_write_sees(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "a", 0), (1, "b", 0), (2, None, 0), (3, "z", 1)], "id int, kind string, part_no int")
    checks = versions.Checks(("kind",), {"kind": ("a", "b")}, ("id",))
    tables = VersionedTables(str(tmp_path / "t"))
    with pytest.raises(RefusedLoad) as refused:
        tables.publish(spark, "x", {"t": versions.TableLoad(rows, "part_no", checks=checks)})
    assert refused.value.report == {
        "t": {"null kind": 1, "not allowed kind": 2, "repeated id": 2}}
    assert tables.pointer(spark) == {} and tables.read(spark, "t", rows.schema).isEmpty()
    good = rows.where("kind = 'a'")
    assert tables.publish(spark, "y", {"t": versions.TableLoad(good, "part_no", checks=checks)}) == {
        "t": {"rows": 1, "null kind": 0, "not allowed kind": 0, "repeated id": 0}}
    with pytest.raises(ValueError, match="published already"):
        tables.publish(spark, "y", {"t": versions.TableLoad(good, "part_no")})
    # A part that a load leaves empty is gone; others stay.
    more = rows.where("id = 3")
    tables.publish(spark, "z", {"t": versions.TableLoad(more, "part_no", (0, 1))})
    assert [r.id for r in tables.read(spark, "t", rows.schema).collect()] == [3]


def test_loads_of_the_query_leave_packed_extracts_and_one_version(spark, sf_dir):
    """What was loaded before is deleted, and extracts are not stored as plain text."""
    root = pathlib.Path(queries._ingested(spark, sf_dir))
    for name in ("orders", "order_items"):
        parts = list((root / f"{name}.csv").glob("part-*"))
        assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    pointers = [p for p in (root / "_pointers").iterdir() if p.name.isdigit()]
    assert len(pointers) == 1
    used = {v for parts in json.loads(pointers[0].read_text()).values() for v in parts.values()}
    assert {p.name for p in (root / "_data").iterdir()} == used


def test_a_load_moves_its_buckets_once(spark, tmp_path, monkeypatch):
    plans, write = [], versions.overwrite

    def recorded(rows, path, *partitions):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, *partitions)

    root = str(tmp_path / "shop")
    first = ("A", "C1", "Pending", "1.00", "2024-01-01", "2024-01-01")
    create_table(order_rows(spark, first), root, ORDERS, 2)
    monkeypatch.setattr(versions, "overwrite", recorded)
    new = order_rows(
        spark, ("A", "C9", "Completed", "2.00", "2024-01-02", "2024-01-02"),
        ("N", "C2", "Pending", "3.00", "2024-01-02", "2024-01-02"))
    new.write.parquet(str(tmp_path / "new"))
    new = spark.read.schema(ORDERS.schema).parquet(str(tmp_path / "new"))
    tables = VersionedTables(root)
    load = ingest.upserted_buckets(spark, root, new, ORDERS, tables.pointer(spark))
    tables.publish(spark, "day", {ORDERS.name: load})
    assert as_dict(source_table(spark, root, ORDERS)) == {
        "A": ("C1", "Completed", "2.00", "2024-01-01"), "N": ("C2", "Pending", "3.00", "2024-01-02")}
    # Only the rows of incoming keys are joined both ways, and no rows move again to be written.
    assert "LeftAnti" in plans[0] and "REBALANCE" not in plans[0].upper()
