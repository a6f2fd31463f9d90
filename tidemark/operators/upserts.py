"""Keyed upserts as joins: insert new keys, replace only the mutable columns of known ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import ShopTable


def with_defaults(rows: DataFrame, table: ShopTable) -> DataFrame:
    """Fill columns that arrive empty with the table's defaults."""
    for name, sql in table.defaults:
        kind = table.schema[name].dataType
        rows = rows.withColumn(name, F.coalesce(F.col(name), F.expr(sql).cast(kind)))
    return rows


def one_row_per_key(incoming: DataFrame, table: ShopTable, order: str = "updated_at") -> DataFrame:
    """What applying the incoming rows one after the other leaves per key.

    The first row inserts, later ones replace the mutable columns, so the fixed
    columns come from the lowest row and the mutable ones from the highest. Rows
    with equal ``order`` rank by their other columns, which keeps the outcome the
    same on every run.
    """
    fixed = [c for c in table.columns if c != table.key and c not in table.mutable]
    rank = F.struct(order, *(c for c in table.columns if c != order))
    merged = incoming.groupBy(table.key).agg(
        F.min_by(F.struct(*fixed), rank).alias("first"),
        F.max_by(F.struct(*table.mutable), rank).alias("last"),
    )
    return merged.select(table.key, "first.*", "last.*").select(*table.columns)


def keyed_upsert(target: DataFrame, incoming: DataFrame, table: ShopTable) -> DataFrame:
    """The target after the incoming rows; both hold at most one row per key."""
    old, new = target.alias("old"), incoming.alias("new")
    known = F.col(f"old.{table.key}").isNotNull()
    touched = F.col(f"new.{table.key}").isNotNull()

    def outcome(name: str):
        before, after = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name == table.key:
            return F.coalesce(before, after).alias(name)
        if name in table.mutable:
            return F.when(touched, after).otherwise(before).alias(name)
        return F.when(known, before).otherwise(after).alias(name)

    joined = old.join(new, F.col(f"old.{table.key}") == F.col(f"new.{table.key}"), "full_outer")
    return joined.select(*map(outcome, table.columns))


def insert_if_absent(target: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """The target plus the candidates whose key it lacks."""
    return target.unionByName(candidates.join(target.select(key), key, "left_anti"))
