"""Tables laid out along a Z-curve, so that readers by day and readers by key both skip most of them.

Sorted by day and then key, a table can be pruned by day only: every day has all keys. Here each row
gets a cell of a grid over days and keys, whose lines are quantiles of the data (so that cells are
about even, whatever the data), and cells are ordered by their interleaved bits. Row groups then hold
a narrow range of both, and their statistics tell readers which to skip. Rows are dealt out by range
of cell, key and day, so a cell that is too full is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.tables import CODEC

#: Bits of a row's place on each side of the grid: 64 by 64 cells.
BITS = 6
#: Bytes of a text that its place follows from; texts are ordered by their bytes.
_PREFIX = 7


def text_number(column: str) -> Column:
    """A number that orders texts as their first bytes do."""
    return F.expr(
        f"CAST(conv(hex(substring(rpad(CAST({column} AS BINARY), {_PREFIX}, X'00'), 1, {_PREFIX})), "
        "16, 10) AS BIGINT)")


def interleaved(first: Column, second: Column, bits: int = BITS) -> Column:
    """The bits of two numbers in turn, those of the first one higher."""
    parts = []
    for i in range(bits):
        for number, place in ((first, 2 * i + 1), (second, 2 * i)):
            bit = F.shiftright(number, i).bitwiseAND(1)
            parts.append(F.shiftleft(bit, place))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def _cell(value: Column, lines: list[int]) -> Column:
    """How many of the lines a value reaches, found by halves."""
    held = sorted(set(lines))

    def among(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last) // 2
        return F.when(value >= F.lit(held[middle]).cast("long"), among(middle + 1, last)).otherwise(
            among(first, middle))

    return among(0, len(held))


def in_z_order(rows: DataFrame, day: str, key: str, files: int, bits: int = BITS) -> DataFrame:
    """The rows dealt out and sorted along the curve; rows without a day or key come first.

    Only the grid's lines, 2 ** ``bits`` quantiles a side, come to the driver.
    """
    numbers = F.unix_date(F.to_date(day)).cast("long"), text_number(key)
    shares = [i / 2**bits for i in range(1, 2**bits)]
    lines = rows.select(*(n.alias(f"_{i}") for i, n in enumerate(numbers))).agg(
        *(F.percentile_approx(f"_{i}", shares, 10_000).alias(f"_{i}") for i in range(2))).first()
    # Numbers and cells have columns of their own, so that a row's are worked out once.
    placed = rows.withColumns({f"_n{i}": n for i, n in enumerate(numbers)})
    placed = placed.withColumns(
        {f"_c{i}": _cell(F.col(f"_n{i}"), lines[i] or []) for i in range(2)})
    placed = placed.withColumn(
        "_z", F.coalesce(interleaved(F.col("_c0"), F.col("_c1"), bits), F.lit(-1)))
    return placed.drop("_n0", "_n1", "_c0", "_c1").repartitionByRange(
        files, "_z", key, day).sortWithinPartitions("_z", key, day).drop("_z")


def write_z_ordered(
    rows: DataFrame, path: str, day: str, key: str, files: int, row_group_bytes: int = 1 << 27
) -> None:
    (
        in_z_order(rows, day, key, files).write.mode("overwrite").option("compression", CODEC)
        .option("parquet.block.size", row_group_bytes).parquet(path)
    )
