from __future__ import annotations

from tidemark.operators import checks


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "k string")
    assert rows(checks.duplicate_keys(df, ["k"])) == [("A", 2)]


def test_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(checks.null_counts(df, ["a", "b"])) == [(2, "a", 1), (2, "b", 2)]


def test_references(spark):
    items = spark.createDataFrame([("I1", "A"), ("I2", "B"), ("I3", "B")], "item string, k string")
    parents = spark.createDataFrame([("A",), ("C",)], "k string")
    assert rows(checks.orphans(items, parents, "k").select("item")) == [("I2",), ("I3",)]
    assert rows(checks.cascade_delete(items, parents, "k").select("item")) == [("I2",), ("I3",)]
    wanted = spark.createDataFrame([("B",), ("C",)], "k string")
    assert rows(checks.restricted_deletes(items, wanted, "k")) == [("B", 2)]


def test_values_outside_the_list(spark):
    df = spark.createDataFrame([("Pending",), ("Lost",), ("Lost",), (None,)], "status string")
    got = {(r.status, r.n_rows) for r in checks.disallowed_values(df, "status", ["Pending"]).collect()}
    assert got == {("Lost", 2), (None, 1)}


def test_reconcile(spark):
    kind = "k string, a int, b string"
    left = spark.createDataFrame([("1", 1, None), ("2", 2, "x"), ("3", 3, "y")], kind)
    right = spark.createDataFrame([("1", 1, None), ("2", 5, None), ("4", 4, "z")], kind)
    assert rows(checks.reconcile(left, right, "k", ["a", "b"])) == [
        ("2", "differs", "a,b"), ("3", "only_left", ""), ("4", "only_right", ""),
    ]
