"""Tables whose loads are seen whole or not at all, and are checked while they are written.

    _data/<load>/<table>/part=<n>/   what a load wrote
    _pointers/<number>               which load each part of each table is read from

A load writes the parts it changes under a name of its own, then one small file that says where
every part is read from now on. That file comes into being by a rename, so a reader sees all tables
as they were before the load or all as they are after it; it looks the pointer up once and reads
several tables by it. Earlier data stays until ``vacuum``, for those who still read by an older
pointer. One writer at a time.

The write itself counts rows, NULLs, values outside a list and repeated keys (``observe``); a load
with a violation is refused before it is pointed to, and nothing is read a second time for it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.sinks.tables import _hadoop_path, overwrite, spread

PART = "part"
_COPIES = "_copies"

#: For each table, the load that each part is read from.
Pointer = dict[str, dict[str, str]]


class RefusedLoad(ValueError):
    """A load that breaks its checks; ``report`` has what was counted."""

    def __init__(self, load: str, report: dict[str, dict[str, int]]):
        super().__init__(f"load {load} refused: {report}")
        self.report = report


@dataclass(frozen=True)
class Checks:
    """What a table's rows must keep to."""

    not_null: Sequence[str] = ()
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)
    unique: Sequence[str] = ()

    def observed(self, rows: DataFrame, observation: Observation) -> DataFrame:
        """The rows, counted on their way."""
        counts = [F.count(F.lit(1)).alias("rows")]
        for c in self.not_null:
            counts.append(F.count_if(F.col(c).isNull()).alias(f"null {c}"))
        for c, values in self.allowed.items():
            outside = ~F.col(c).isin(list(values)) | F.col(c).isNull()
            counts.append(F.count_if(outside).alias(f"not allowed {c}"))
        if not self.unique:
            return rows.observe(observation, *counts)
        copies = F.count(F.lit(1)).over(Window.partitionBy(*self.unique))
        counts.append(F.count_if(F.col(_COPIES) > 1).alias("repeated " + ",".join(self.unique)))
        return rows.withColumn(_COPIES, copies).observe(observation, *counts).drop(_COPIES)


@dataclass(frozen=True)
class TableLoad:
    """New content of some parts of a table.

    ``part`` is the column that tells a row's part; ``parts`` lists those the load replaces, also
    those it leaves empty. Without it they are the ones that ``rows`` has.
    """

    rows: DataFrame
    part: str
    parts: Sequence[int] | None = None
    checks: Checks = Checks()


@dataclass(frozen=True)
class VersionedTables:
    root: str

    def _numbers(self, spark: SparkSession) -> list[int]:
        path, fs = _hadoop_path(spark, f"{self.root}/_pointers")
        if not fs.exists(path):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(path))
        return sorted(int(n) for n in names if n.isdigit())

    def _read_pointer(self, spark: SparkSession, number: int) -> Pointer:
        path, fs = _hadoop_path(spark, f"{self.root}/_pointers/{number:012d}")
        stream = fs.open(path)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def pointer(self, spark: SparkSession) -> Pointer:
        """Where all tables are read from, as of the last load that was published."""
        numbers = self._numbers(spark)
        return self._read_pointer(spark, numbers[-1]) if numbers else {}

    def read(
        self, spark: SparkSession, table: str, schema: T.StructType, pointer: Pointer | None = None,
        parts: Sequence[int] | None = None,
    ) -> DataFrame:
        """A table, or some of its parts, as the pointer has it."""
        held = (self.pointer(spark) if pointer is None else pointer).get(table, {})
        wanted = held if parts is None else {str(p) for p in parts} & held.keys()
        paths = [f"{self.root}/_data/{held[p]}/{table}/{PART}={p}" for p in sorted(wanted)]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)

    def next_load(self, spark: SparkSession, label: str) -> str:
        """A name for a load on top of the last one published."""
        numbers = self._numbers(spark)
        return f"{label}-{(numbers[-1] if numbers else 0) + 1:012d}"

    def publish(
        self, spark: SparkSession, load: str, tables: Mapping[str, TableLoad]
    ) -> dict[str, dict[str, int]]:
        """Write, check and point to a load; what was counted, by table.

        Raises ``RefusedLoad`` where a check fails; readers never see such a load. A load of the
        same name that did not get so far is written anew, and one that is published is refused.
        """
        held = self.pointer(spark)
        if any(load in parts.values() for parts in held.values()):
            raise ValueError(f"load {load} is published already")
        report, written = {}, {}
        for name, table in tables.items():
            observation = Observation(f"{load}-{name}")
            rows = table.checks.observed(table.rows.withColumn(PART, F.col(table.part)), observation)
            path = f"{self.root}/_data/{load}/{name}"
            # Looking for repeated keys has spread the rows evenly: they are written where they are.
            overwrite(rows if table.checks.unique else spread(rows, PART), path, PART)
            report[name] = observation.get
            written[name] = self._parts_of(spark, path)
        broken = {
            name: {k: n for k, n in counts.items() if k != "rows" and n}
            for name, counts in report.items()}
        if any(broken.values()):
            raise RefusedLoad(load, broken)
        pointer = {name: dict(parts) for name, parts in held.items()}
        for name, table in tables.items():
            parts = pointer.setdefault(name, {})
            for part in written[name] if table.parts is None else map(str, table.parts):
                parts.pop(part, None)
            parts |= {part: load for part in written[name]}
        self._point(spark, pointer)
        return report

    def _parts_of(self, spark: SparkSession, path: str) -> list[str]:
        target, fs = _hadoop_path(spark, path)
        names = (s.getPath().getName().partition("=") for s in fs.listStatus(target))
        return [value for name, _, value in names if name == PART]

    def _point(self, spark: SparkSession, pointer: Pointer) -> None:
        numbers = self._numbers(spark)
        name = f"{(numbers[-1] if numbers else 0) + 1:012d}"
        draft, fs = _hadoop_path(spark, f"{self.root}/_pointers/.draft-{name}")
        final, _ = _hadoop_path(spark, f"{self.root}/_pointers/{name}")
        out = fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(pointer).encode()))
        finally:
            out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"{self.root}: another load was published meanwhile")

    def vacuum(self, spark: SparkSession, keep: int = 1) -> None:
        """Delete all but the last ``keep`` pointers, and loads that none of these has."""
        numbers = self._numbers(spark)
        used = {
            load for n in numbers[-keep:] for parts in self._read_pointer(spark, n).values()
            for load in parts.values()}
        for n in numbers[:-keep]:
            path, fs = _hadoop_path(spark, f"{self.root}/_pointers/{n:012d}")
            fs.delete(path, False)
        data, fs = _hadoop_path(spark, f"{self.root}/_data")
        if fs.exists(data):
            for status in fs.listStatus(data):
                if status.getPath().getName() not in used:
                    fs.delete(status.getPath(), True)
