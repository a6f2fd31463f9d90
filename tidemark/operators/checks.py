"""Constraint checks. Each returns the violations, so an empty result means clean."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows and NULLs per column, all columns in one pass."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(F.col(c).isNull()).alias(c) for c in columns),
    )
    return counts.unpivot(["n_rows"], list(columns), "column_name", "n_nulls")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent row."""
    return children.join(parents.select(key), key, "left_anti")


def cascade_delete(children: DataFrame, deleted: DataFrame, key: str) -> DataFrame:
    """The children left after their parents' deletion takes theirs along."""
    return children.join(deleted.select(key), key, "left_anti")


def restricted_deletes(children: DataFrame, requested: DataFrame, key: str) -> DataFrame:
    """Requested parent deletes that child rows forbid, with the number of children.

    Children are counted per key before the join, so one parent with a third of
    them shuffles as a few rows.
    """
    references = children.groupBy(key).agg(F.count(F.lit(1)).alias("n_references"))
    return references.join(requested.select(key), key, "left_semi")


def disallowed_values(rows: DataFrame, column: str, allowed: Iterable[str]) -> DataFrame:
    """Values outside the allowed list, NULL included, with the number of rows."""
    outside = ~F.col(column).isin(list(allowed)) | F.col(column).isNull()
    return rows.where(outside).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys on which two copies of a table disagree, and how.

    ``verdict`` is ``only_left``, ``only_right`` or ``differs``; ``differing``
    names the columns in question. NULL equals NULL.
    """
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    in_left, in_right = F.col(f"a.{key}").isNotNull(), F.col(f"b.{key}").isNotNull()
    unequal = [~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]
    names = F.concat_ws(",", *(F.when(u, F.lit(c)) for u, c in zip(unequal, columns)))
    verdict = (
        F.when(~in_right, "only_left").when(~in_left, "only_right")
        .when(reduce(lambda x, y: x | y, unequal), "differs")
    )
    both = in_left & in_right
    return joined.select(
        F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key),
        verdict.alias("verdict"),
        F.when(both, names).otherwise("").alias("differing"),
    ).where(F.col("verdict").isNotNull())


# Copies that nearly agree -----------------------------------------------------------

#: Bits of the key's hash that make up a range, level by level.
LEVELS = (10, 20)


def _hashed(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The rows with a hash of their key and one of all columns, where NULL is a value too."""
    marked = [x for c in (key, *columns) for x in (F.col(c), F.col(c).isNull())]
    return rows.withColumn("_key_hash", F.xxhash64(key)).withColumn("_row_hash", F.xxhash64(*marked))


def _range(bits: int):
    return F.shiftrightunsigned("_key_hash", 64 - bits)


def range_digests(rows: DataFrame, bits: int) -> DataFrame:
    """Per range of hashed keys the number of rows and sums of their hashes, in any order.

    Each task adds its rows up first, so a range leaves it as one row.
    """
    halves = F.col("_row_hash").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("_row_hash", 32)
    return rows.groupBy(_range(bits).alias("_range")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(halves[0]).alias("low"), F.sum(halves[1]).alias("high"))


def differing_ranges(left: DataFrame, right: DataFrame, bits: int) -> DataFrame:
    """Ranges whose digests differ, or that only one side has."""
    a, b = (range_digests(rows, bits) for rows in (left, right))
    equal = a.join(b, ["_range", "n", "low", "high"], "left_semi")
    only = [x.join(equal, "_range", "left_anti").select("_range") for x in (a, b)]
    return only[0].unionByName(only[1]).distinct()


def reconcile_by_digests(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], work_path: str,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """As ``reconcile``, for copies that are expected to agree but for a few rows.

    The sides are compared by digests of key ranges, and the ranges that differ by digests of
    smaller ranges within them; only rows of ranges that differ on the last level are joined.
    Where the copies agree, one row a range and task is all that moves.
    """
    spark = left.sparkSession
    sides = [_hashed(rows.select(key, *columns), key, columns) for rows in (left, right)]
    for bits in levels:
        path = f"{work_path}/differing-{bits}"
        differing_ranges(*sides, bits).write.mode("overwrite").parquet(path)
        found = spark.read.schema("_range long").parquet(path)
        sides = [
            rows.withColumn("_range", _range(bits)).join(found, "_range", "left_semi").drop("_range")
            for rows in sides
        ]
    return reconcile(*(rows.select(key, *columns) for rows in sides), key, columns)
