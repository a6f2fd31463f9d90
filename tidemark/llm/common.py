"""Helpers of the operators: stored results, Python over Arrow batches, texts as arrays.

Texts of a batch are handled together as one byte array with offsets, in parts of a few
megabytes, so that a task's memory follows its largest document and not its input.
"""

from __future__ import annotations

import ctypes
import importlib
import os
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import work_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Bytes of text worked on at once; a longer document is worked on alone.
PART_BYTES = 1 << 20

LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables written by the stage at work, where somebody asked for them.
_written: list[str] | None = None


def stored(rows: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The rows as a written table in the shared folder, so that lost executors lose nothing."""
    spark, path = rows.sparkSession, work_dir(rows.sparkSession, label)
    rows.write.parquet(path, compression=codec)
    if _written is not None:
        _written.append(path)
    # What was shuffled for it goes from the executors' disks once the driver has let go of it.
    spark._jvm.java.lang.System.gc()
    found = spark.read.schema(rows.schema).parquet(path)
    found.stored_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for rows in tables:
        _delete(rows.sparkSession, rows.stored_path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def tables_of_stage(docs: DataFrame, left: list[str]) -> Iterator[None]:
    """Keeps in ``left`` the tables that a stage writes on its way.

    Those of the stage before, which are in it at first, are deleted, but for what ``docs``
    itself still reads: a caller may pass on a result that was not written yet.
    """
    global _written
    read = docs.inputFiles() if left else []
    for path in left:
        if not any(path.rpartition("/")[2] in file for file in read):
            _delete(docs.sparkSession, path)
    left[:] = [p for p in left if any(p.rpartition("/")[2] in file for file in read)]
    outer, _written = _written, left
    try:
        yield
    finally:
        _written = outer


def id_key(column: str = "doc_id") -> Column:
    """The document's place in the order: its id, and after all others if it has none."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def quoted(name: str) -> str:
    """A column's name as it stands, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def other_columns(docs: DataFrame, *without: str) -> Column:
    """All columns but those named, as one column ``row``."""
    kept = [F.col(quoted(c)) for c in docs.columns if c not in without]
    return F.struct(*kept).alias("row")


def with_row(rows: DataFrame, more: str) -> T.StructType:
    """The schema of ``rows``' column ``row`` and the columns of ``more``."""
    return T.StructType([rows.schema["row"], *T.StructType.fromDDL(more).fields])


def give_back() -> None:
    """Return to the system what a task's arrays took: its worker waits for others' tasks with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def mapped(rows: DataFrame, work, schema: str | T.StructType, **given) -> DataFrame:
    """``work(batches, **given)`` over the Arrow batches of each partition."""
    root, here, module, name = ROOT, __name__, work.__module__, work.__name__

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.insert(0, root)
        yield from getattr(importlib.import_module(module), name)(batches, **given)
        importlib.import_module(here).give_back()

    return rows.mapInArrow(run, schema)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    if not len(texts) or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(
    batches: Iterable[pa.RecordBatch], column: str = "text", most: int = PART_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield (
                batch.slice(at, end - at),
                data[offsets[at] : offsets[end]],
                offsets[at : end + 1] - offsets[at],
            )
            at = end


def binary(cells: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional byte array as Arrow binaries."""
    count, width = cells.shape
    places = np.arange(0, (count + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(
        pa.binary(), count, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(cells))]
    )


# Hashes --------------------------------------------------------------------------

_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 2**64)


def mix(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value spread over all bits, one to one."""
    out = values ^ (values >> np.uint64(33))
    out *= np.uint64(0xFF51AFD7ED558CCD)
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xC4CEB9FE1A85EC53)
    out ^= out >> np.uint64(33)
    return out


def spread_values(count: int, seed: int) -> np.ndarray:
    return mix(np.arange(seed + 1, seed + count + 1, dtype=np.uint64) * np.uint64(_STEP))


_VALUE = spread_values(256, 1000)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(count: int) -> list[np.ndarray]:
    if len(_powers[0]) < count:
        for i, base in enumerate((_BASE, _BACK)):
            values = np.full(count, base, np.uint64)
            values[0] = 1
            _powers[i] = np.cumprod(values, dtype=np.uint64)
    return _powers


class Sums:
    """Hashes of any stretch of an array in constant time: polynomials modulo 2**64.

    ``values`` has a random number for each thing the array can hold, bytes unless given.
    """

    def __init__(self, data: np.ndarray, values: np.ndarray | None = None):
        up, self.down = _grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        values = _VALUE if values is None else values
        np.cumsum(values[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unmixed hashes; equal stretches of equal length have equal ones."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def runs(self, width: int) -> np.ndarray:
        """The hash of every stretch of ``width`` bytes."""
        count = len(self.sums) - width
        if count <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[width:] - self.sums[:count]) * self.down[:count])


def byte_set(text: bytes) -> np.ndarray:
    marked = np.zeros(256, bool)
    marked[np.frombuffer(text, np.uint8)] = True
    return marked


SPACE = byte_set(b" \t\n\v\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(
    data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes outside ``gaps``."""
    count = len(data)
    if not count:
        return (np.zeros(0, np.int64),) * 3
    solid = ~gaps[data]
    edge = np.zeros(count + 1, bool)
    edge[offsets] = True
    before, after = edge[:-1].copy(), edge[1:].copy()
    before[1:] |= ~solid[:-1]
    after[:-1] |= ~solid[1:]
    before[0] = after[-1] = True
    starts, ends = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    length = (ends - starts).astype(np.uint64)
    return mix(Sums(data).of(starts, ends) + length * np.uint64(_STEP))


def shingles(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash and owner of every run of ``width`` words inside one text."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(count, np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(3) + hashes[i : i + count] + np.uint64(i))
    whole = owner[:count] == owner[width - 1 :]
    return out[whole], owner[:count][whole]
