"""Line dedup: lines found in several documents stay only in the first of them.

Lines are exploded and hashed (128 bits); each hash gets its first and last document, so
that an aggregate combined on the map side tells the lines found in two documents or more,
however hot a line is. Lines that hold more than one in ``SHARE`` of all rows are then met
where they lie, by a broadcast of at most ``SHARE`` rows; all others by a shuffle. The hashes
that a document loses are gathered for that document, whose lines are then joined again by
position. Texts move once, to meet these hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_key, mapped, other_columns, stored, table, with_row

#: Shorter keys (in code points) are never dropped.
LEAST_LENGTH = 10

#: A line is hot from one in so many of all rows, so that there are never more hot lines.
SHARE = 1000


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\v\f\r").lower()


def _long_enough(key: bytes, least: int) -> bool:
    if len(key) < least or len(key) >= 4 * least:
        return len(key) >= least
    return len(key.decode()) >= least


def _digests(text: bytes, least: int) -> list[bytes | None]:
    """For each line the hash of its key, or None where it is too short to be dropped."""
    keys = map(line_key, text.split(b"\n"))
    return [xxhash.xxh3_128_digest(k) if _long_enough(k, least) else None for k in keys]


def line_hashes(batches, least):
    for batch in batches:
        owners, found = [], []
        for key, text in zip(batch["k"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = {d for d in _digests((text or "").encode(), least) if d}
            owners += [key] * len(own)
            found += own
        halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(owners, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
            names=["k", "h1", "h2"],
        )


def without_lines(batches, least):
    for batch in batches:
        texts, counts, dropped = [], [], []
        lost = batch["lost"].to_pylist()
        for text, gone in zip(batch["text"].to_pylist(), lost, strict=True):
            raw = (text or "").encode()
            counts.append(raw.count(b"\n") + 1)
            if not gone:
                texts.append(text)
                dropped.append(0)
                continue
            gone = {np.array((g["h1"], g["h2"]), np.int64).tobytes() for g in gone}
            lines = raw.split(b"\n")
            kept = [
                x for x, d in zip(lines, _digests(raw, least), strict=True) if d not in gone
            ]
            texts.append(b"\n".join(kept).decode())
            dropped.append(len(lines) - len(kept))
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
             pa.array(dropped, pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )


def drop_repeated_lines(
    docs: DataFrame, least: int = LEAST_LENGTH, share: int = SHARE
) -> DataFrame:
    """One row per document: ``row`` (all its columns but the text), ``text``, counts.

    A line's key is the line without white space at its ends, A to Z lower-cased. Keys of
    ``least`` code points or more that two documents hold lose their lines in all but the
    document with the smallest id. Rows that share an id count as one document. A document
    without an id comes after all others. A null text has one empty line and stays null; a
    document may end up with an empty text. An empty table gives an empty result.
    """
    rows = docs.select(
        other_columns(docs, "text"),
        id_key().alias("k"), F.col("text").cast("string").alias("text"),
    )
    lines = stored(
        mapped(rows.select("k", "text"), line_hashes, "k long, h1 long, h2 long", least=least),
        "lines",
    )
    repeated = stored(
        lines.groupBy("h1", "h2").agg(
            F.min("k").alias("first"), F.max("k").alias("last"), F.count("*").alias("n"))
        .where("first < last").drop("last"),
        "repeated",
    )
    hot_from = lines.count() / share
    hot = F.broadcast(repeated.where(F.col("n") > hot_from).drop("n"))
    rest = lines.join(hot, ["h1", "h2"], "left_anti").join(
        repeated.where(F.col("n") <= hot_from).drop("n"), ["h1", "h2"])
    lost = (
        lines.join(hot, ["h1", "h2"]).unionByName(rest).where("k <> first")
        .groupBy("k").agg(F.collect_set(F.struct("h1", "h2")).alias("lost"))
    )
    return mapped(
        rows.join(lost, "k", "left").drop("k"), without_lines,
        with_row(rows, "text string, n_lines long, n_dropped long"), least=least,
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


ORACLE_SQL = """
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeated AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
    SELECT k.*, r.first IS NOT NULL AND r.first <> k.doc_id AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
