"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text's letters are lower-cased, all else is one space, and every run of one to ``LONGEST``
characters that holds a letter is hashed into one of ``BUCKETS`` buckets. Training counts buckets
per language in each task, as arrays, and adds the counts up by language and bucket: its size is
languages times buckets, whatever the input. The matrix of log probabilities is broadcast.
Scoring is a sparse product: a batch's texts are rows of bucket numbers, whose matrix rows are
summed per text. More than ``BLOCK`` languages are scored in blocks, one pass over the texts each,
so that what is broadcast has a bound.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, mix, other_columns, parts, stored, table, with_row

LONGEST = 4
BUCKETS = 1 << 16
#: Counted for each bucket before any text is seen.
SMOOTHING = 0.5
#: Languages in a broadcast matrix: 64 of 65,536 buckets take 32 MB.
BLOCK = 64
#: Characters worked on at once.
STRIDE = 1 << 19

#: For a text without letters.
UNKNOWN = "und"

_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, or else a space."""
    found = np.full(sys.maxunicode + 1, _SPACE, np.uint32)
    for point in range(sys.maxunicode + 1):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            found[point] = ord(lower) if len(lower) == 1 else point
    return found


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and single spaces of the texts, each text behind a space, and where each begins."""
    raw = data.tobytes()
    try:
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    except UnicodeDecodeError:
        texts = [raw[a:b].decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    found = np.insert(_letters()[points], starts[:-1], _SPACE)
    starts = starts + np.arange(len(starts))
    kept = np.ones(len(found), bool)
    kept[1:] = (found[1:] != _SPACE) | (found[:-1] != _SPACE)
    kept[starts[:-1]] = True
    return found[kept], np.concatenate(([0], np.cumsum(kept)))[starts]


def with_letters(chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
    owner = np.searchsorted(starts, np.flatnonzero(chars != _SPACE), side="right") - 1
    return np.bincount(owner, minlength=len(starts) - 1) > 0


def gram_rows(chars: np.ndarray, starts: np.ndarray, longest: int, buckets: int):
    """Bucket and text of every gram, in pieces: the grams of one length from ``STRIDE`` places."""
    count = len(chars)
    for low in range(0, count, STRIDE):
        high = min(low + STRIDE, count)
        piece = chars[low : min(high + longest - 1, count)].astype(np.uint64)
        owner = np.searchsorted(starts, np.arange(low, low + len(piece)), side="right") - 1
        gram = np.zeros(high - low, np.uint64)
        for length in range(1, longest + 1):
            n = min(high - low, len(piece) - length + 1)
            if n <= 0:
                break
            gram = mix(gram[:n] * np.uint64(31) + piece[length - 1 : length - 1 + n] + np.uint64(length))
            whole = owner[:n] == owner[length - 1 : length - 1 + n]
            if length == 1:
                whole = whole & (piece[:n] != _SPACE)
            yield (gram[whole] & np.uint64(buckets - 1)).astype(np.int64), owner[:n][whole]


# Training ------------------------------------------------------------------------


def count_rows(batches, longest, buckets):
    """Buckets' counts per language, summed over the task's texts, and the texts with letters.

    The texts of a language are counted in bucket number ``buckets``.
    """
    held: dict[str, np.ndarray] = {}

    def counted(name, counts):
        found = np.flatnonzero(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([name] * len(found), pa.string()), pa.array(found, pa.int32()),
             pa.array(counts[found])],
            names=["lang", "bucket", "n"])

    for batch, data, offsets in parts(batches):
        chars, starts = characters(data, offsets)
        names, number = np.unique(np.array(batch["lang"].to_pylist()), return_inverse=True)
        number[~with_letters(chars, starts)] = len(names)
        for at in range(0, len(names), BLOCK):
            if len(held) > BLOCK:
                yield from (counted(*item) for item in held.items())
                held.clear()
            block = names[at : at + BLOCK].tolist()
            place = np.where((number >= at) & (number < at + len(block)), number - at, len(block))
            totals = np.zeros((len(block) + 1) * (buckets + 1), np.int64)
            for bucket, owner in gram_rows(chars, starts, longest, buckets):
                totals += np.bincount(
                    place[owner] * (buckets + 1) + bucket, minlength=len(totals))
            totals = totals.reshape(-1, buckets + 1)
            totals[:, buckets] = np.bincount(place, minlength=len(block) + 1)
            for name, counts in zip(block, totals, strict=False):
                held[name] = held.get(name, 0) + counts
    yield from (counted(*item) for item in held.items())


@dataclass(frozen=True)
class Languages:
    """The trained model: counts of buckets and texts per language, as a stored table."""

    counts: DataFrame
    names: list[str]
    longest: int
    buckets: int

    def blocks(self):
        """Names and log probabilities (a row per bucket, priors last) of the languages."""
        texts = self.counts.where(F.col("bucket") == self.buckets).agg(F.sum("n")).first()[0] or 0
        for at in range(0, len(self.names), BLOCK):
            names = self.names[at : at + BLOCK]
            rows = self.counts.where(F.col("lang").isin(names)).toArrow()
            place = {name: i for i, name in enumerate(names)}
            lang = np.array([place[x] for x in rows["lang"].to_pylist()], np.int64)
            found = np.zeros((self.buckets + 1, len(names)))
            found[rows["bucket"].to_numpy(), lang] = rows["n"].to_numpy()
            grams = found[:-1] + SMOOTHING
            yield names, np.vstack((
                np.log(grams / grams.sum(axis=0)), np.log(found[-1:] / texts)))


def learn(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> Languages:
    """The model of ``lang`` from ``text``, over all rows that have a language and a letter."""
    rows = docs.where("lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = mapped(
        rows, count_rows, "lang string, bucket int, n long", longest=longest, buckets=buckets)
    counts = stored(counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "languages")
    named = counts.where((F.col("bucket") == buckets) & (F.col("n") > 0)).select("lang")
    return Languages(counts, sorted(r[0] for r in named.collect()), longest, buckets)


# Scoring -------------------------------------------------------------------------


def _sums(chars, starts, matrix, longest):
    """The sum of each text's rows of the matrix."""
    totals = np.zeros((len(starts) - 1, matrix.shape[1]))
    for bucket, owner in gram_rows(chars, starts, longest, len(matrix) - 1):
        if not len(owner):
            continue
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for at in range(0, matrix.shape[1], 8):
            part = matrix[bucket, at : at + 8]
            totals[owner[first], at : at + 8] += np.add.reduceat(part, first, axis=0)
    return totals + matrix[-1]


def score_rows(batches, model, longest, keep_text):
    """The best language so far, its log probability, the runner-up's and the sum of all."""
    names, matrix = model.value
    names = np.array(names, object)
    for batch, data, offsets in parts(batches):
        chars, starts = characters(data, offsets)
        found = _sums(chars, starts, matrix, longest)
        order = np.argsort(-found, axis=1, kind="stable")
        rows = np.arange(batch.num_rows)
        best, top = names[order[:, 0]], found[rows, order[:, 0]]
        next_ = found[rows, order[:, 1]] if len(names) > 1 else np.full(len(rows), -np.inf)
        total = top + np.log(np.exp(found - top[:, None]).sum(axis=1))
        if "best" in batch.schema.names:
            was = np.array(batch["best"].to_pylist(), object)
            top0, next0, total0 = (batch[c].to_numpy() for c in ("top", "next", "total"))
            keeps = top0 >= top
            next_ = np.where(keeps, np.maximum(next0, top), np.maximum(next_, top0))
            best, top = np.where(keeps, was, best), np.where(keeps, top0, top)
            total = np.logaddexp(total, total0)
        out = {
            "row": batch["row"], "text": batch["text"],
            "lettered": pa.array(with_letters(chars, starts)),
            "best": pa.array(best, pa.string()), "top": pa.array(top), "next": pa.array(next_),
            "total": pa.array(total)}
        if not keep_text:
            del out["text"]
        yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))


_SCORES = "lettered boolean, best string, top double, next double, total double"


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), the language and its score.

    ``score`` is the language's posterior probability, ``lead`` the log of its odds against the
    runner-up (null without one). Of languages that tie the first by name wins. A null or empty
    text, one without a letter, and every text where nothing could be learned is ``UNKNOWN``
    with a score of 0. Only the text counts, whole, however long; repeated rows are scored alike;
    an empty table gives no rows.
    """
    rows = docs.select(other_columns(docs, "text"), F.col("text").cast("string").alias("text"))
    left = len(model.names)
    for block in model.blocks():
        left -= len(block[0])
        given = docs.sparkSession.sparkContext.broadcast(block)
        schema = with_row(rows, f"text string, {_SCORES}" if left else _SCORES)
        rows = mapped(rows, score_rows, schema, model=given, longest=model.longest, keep_text=left > 0)
        if left:
            rows = stored(rows, "scores")
    if not model.names:
        rows = rows.select("row", *(
            F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(_SCORES)))
    known = F.col("lettered") & F.col("best").isNotNull()
    lead = F.col("top") - F.col("next")
    return rows.select(
        "row", F.when(known, F.col("best")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(known, F.exp(F.col("top") - F.col("total"))).otherwise(0.0).alias("score"),
        F.when(known & (lead < float("inf")), lead).alias("lead"))


def _remainder() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without an id are neither learned from nor held out."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(_remainder() != 0))
    return identify(docs.select("doc_id", "text"), model).select(
        F.col("row.doc_id").alias("doc_id"),
        F.expr("coalesce(crc32(CAST(CAST(row.doc_id AS STRING) AS BINARY)) % 5 = 0, false)")
        .alias("held_out"), "lang_pred", "score", "lead")
