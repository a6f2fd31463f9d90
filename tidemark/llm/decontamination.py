"""Benchmark decontamination: rare seeds find test items in documents, alignment scores them.

1. An item's seeds are all of its runs of ``SEED`` words. None is left out: an edited copy may
   have kept any of them, and no others.
2. A seed found in a document gives a window of it, which takes in all that an alignment
   through the seed can reach and still have the least score.
3. Seeds of frequent words give many windows. One that has too few of the item's words for
   that score, were they all in order, is dropped; no copy can be among those.
4. Smith-Waterman alignment of words (match 2, mismatch and gap -1) scores item and window;
   the score is the share of the points that the whole item would get. Copies with words
   changed, left out or put in keep most of them.

A copy without a run of ``SEED`` words of its item is not looked for, though it can have the least
score: about 0.5 with every third word changed, 0.75 with a word put in after every two.

Test items are a stated query set: they go to the tasks in blocks of ``BLOCK`` items, each of
which passes over all documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    mapped, other_columns, parts, shingles, table, utf8, with_row, word_hashes, words,
)

SEED = 3

#: Runs of texts looked up at once.
AT_ONCE = 1 << 14

#: Share of an item's points from which a document counts as contaminated.
LEAST_SCORE = 0.5

#: Fewer points (two for a word) are no evidence, however short the item.
LEAST_POINTS = 10

#: Test items sent to the tasks at once; their words are a few megabytes.
BLOCK = 20_000

MATCH, MISMATCH, GAP = 2, -1, -1

_GAPS = np.ones(256, bool)
for _first, _last in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _GAPS[_first:_last] = False


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, owner = words(data, offsets, _GAPS)
    return word_hashes(data, starts, ends), owner


def _lower_parts(batches):
    """As ``parts``, with the bytes of the lower-cased texts."""
    for batch, _, _ in parts(batches):
        yield batch, *utf8(pc.utf8_lower(batch["text"]))


class Items:
    """Test items as arrays: their words, and the place of every run of words."""

    def __init__(self, ids: list[int | None], texts: list[str | None]):
        self.ids = ids
        self.words, owner = _words(*utf8(pc.utf8_lower(pa.array(texts, pa.string()))))
        self.first = np.searchsorted(owner, np.arange(len(ids) + 1))
        runs, of = shingles(self.words, owner, SEED)
        # A run's place in its item: its place among all words, less the item's first.
        at = np.flatnonzero(owner[: len(owner) - SEED + 1] == owner[SEED - 1 :]) \
            if len(owner) >= SEED else np.zeros(0, np.int64)
        order = np.argsort(runs, kind="stable")
        self.runs, self.item = runs[order], of[order]
        self.place = (at - self.first[of])[order]

    def found(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``runs`` are runs of items, and which: a pair for each."""
        if not len(self.runs) or not len(runs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bits = np.zeros(1 << 16, bool)
        bits[(self.runs & np.uint64(0xFFFF)).astype(np.int64)] = True
        near = np.flatnonzero(bits[(runs & np.uint64(0xFFFF)).astype(np.int64)])
        first = np.searchsorted(self.runs, runs[near], side="left")
        many = np.searchsorted(self.runs, runs[near], side="right") - first
        ends = np.cumsum(many)
        total = int(ends[-1]) if len(ends) else 0
        return (np.repeat(near, many),
                np.repeat(first - (ends - many), many) + np.arange(total))


def aligned(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Smith-Waterman points of each row of words with the same row of the other side.

    Words are hashes; 0 in ``items`` and 1 in ``windows`` pad the rows and match nothing.
    """
    count, width = windows.shape
    above, best = np.zeros((count, width + 1), np.int32), np.zeros(count, np.int32)
    slope = np.arange(width, dtype=np.int32) * -GAP
    for i in range(items.shape[1]):
        match = np.where(windows == items[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        here = np.maximum(np.maximum(above[:, :-1] + match, above[:, 1:] + GAP), 0)
        here = np.maximum.accumulate(here + slope, axis=1) - slope
        above[:, 1:] = here
        np.maximum(best, here.max(axis=1), out=best)
    return best


def _padded(values: np.ndarray, first: np.ndarray, last: np.ndarray, pad: int) -> np.ndarray:
    width = int((last - first).max())
    at = first[:, None] + np.arange(width)
    inside = at < last[:, None]
    return np.where(inside, values[np.minimum(at, len(values) - 1)], np.uint64(pad))


def _within(items: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """How many words of each row of ``items`` the same row of the other side has."""
    known, number = np.unique(items, return_inverse=True)
    number = number.reshape(items.shape)
    place = np.minimum(np.searchsorted(known, windows), len(known) - 1)
    row, column = np.nonzero(known[place] == windows)
    met = np.unique(row * len(known) + place[row, column])
    own = np.arange(len(items))[:, None] * len(known) + number
    at = np.minimum(np.searchsorted(met, own), max(len(met) - 1, 0))
    return (met[at] == own).sum(axis=1) if len(met) else np.zeros(len(items), np.int64)


def leaks(data, offsets, items: Items, least: float):
    """Text number, item number and score of every item that a text holds."""
    hashes, owner = _words(data, offsets)
    runs, _ = shingles(hashes, owner, SEED)
    at = np.flatnonzero(owner[: len(owner) - SEED + 1] == owner[SEED - 1 :]) \
        if len(owner) >= SEED else np.zeros(0, np.int64)
    bounds = np.searchsorted(owner, np.arange(len(offsets)))
    found = [np.zeros((2, 0), np.int64)]
    scores = [np.zeros(0)]
    for i in range(0, len(runs), AT_ONCE):
        hit, seed = items.found(runs[i : i + AT_ONCE])
        if len(hit):
            text, item, score = _scored(
                items, hashes, owner, bounds, at[i + hit], seed, least)
            found.append(np.stack([text, item]))
            scores.append(score)
    text, item = np.concatenate(found, axis=1)
    score = np.concatenate(scores)
    order = np.lexsort((-score, item, text))
    text, item, score = text[order], item[order], score[order]
    best = np.ones(len(text), bool)
    best[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1])
    return text[best], item[best], score[best]


def _scored(items: Items, hashes, owner, bounds, at, seed, least: float):
    """As ``leaks``, for seeds met at places ``at``; an item may come several times."""
    item = items.item[seed]
    text = owner[at]
    begin = at - items.place[seed]  # where the item would begin in the text
    # Seeds of about one diagonal share a window.
    step = (items.first[item + 1] - items.first[item]) // 4 + 4
    text, item, begin = np.unique(
        np.stack([text, item, begin // step], axis=1), axis=0).T
    length = items.first[item + 1] - items.first[item]
    step = length // 4 + 4
    begin = begin * step
    # Every word put in costs a point, and more of them leave less than the least score.
    slack = np.ceil(MATCH * length * (1 - least) / -GAP).astype(np.int64)
    first = np.maximum(begin - slack, bounds[text])
    last = np.minimum(begin + step + length + slack, bounds[text + 1])
    order = np.argsort(length, kind="stable")
    text, item, length, first, last = (x[order] for x in (text, item, length, first, last))

    def sides(own):
        return (_padded(items.words, items.first[item[own]], items.first[item[own] + 1], 0),
                _padded(hashes, first[own], last[own], 1))

    points = np.zeros(len(text), np.int64)
    for i in range(0, len(text), 256):
        own = np.arange(i, min(i + 256, len(text)))
        points[own] = MATCH * _within(*sides(own))
    left = np.flatnonzero((points / (MATCH * length) >= least) & (points >= LEAST_POINTS))
    points[:] = 0
    for i in range(0, len(left), 256):
        own = left[i : i + 256]
        points[own] = aligned(*sides(own))
    score = points / (MATCH * length)
    good = (score >= least) & (points >= LEAST_POINTS)
    return text[good], item[good], score[good]


def leak_rows(batches, items, least):
    for batch, data, offsets in _lower_parts(batches):
        text, item, score = leaks(data, offsets, items, least)
        yield pa.RecordBatch.from_arrays(
            [batch["row"].take(pa.array(text)),
             pa.array([items.ids[i] for i in item.tolist()], pa.int64()), pa.array(score)],
            names=["row", "item_id", "score"])


def clean_rows(batches, items, least):
    for batch, data, offsets in _lower_parts(batches):
        text, _, _ = leaks(data, offsets, items, least)
        kept = np.ones(batch.num_rows, bool)
        kept[text] = False
        yield batch.filter(pa.array(kept))


def _as_rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        other_columns(docs, "text"),
        F.col("text").cast("string").alias("text"))


def _blocks(benchmark: DataFrame):
    """The items, block by block."""
    given = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text"))
    count = -(-given.count() // BLOCK)
    for number in range(count):
        rows = given.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number).collect()
        rows.sort(key=lambda r: (r["item_id"] is None, r["item_id"], r["text"] or ""))
        yield Items([r["item_id"] for r in rows], [r["text"] for r in rows])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE
) -> DataFrame:
    """One row per document and item that it holds: ``row`` (its columns but the text),
    item_id and score.

    Null and empty texts hold nothing and are held by nothing, nor are items of fewer than
    five words. Repeated rows give repeated results. Empty tables give no rows.
    """
    rows = _as_rows(docs)
    schema = with_row(rows, "item_id long, score double")
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark):
        out = out.unionByName(mapped(rows, leak_rows, schema, items=items, least=least))
    return out


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE
) -> DataFrame:
    """The documents that hold no test item, with their columns."""
    rows = _as_rows(docs)
    for items in _blocks(benchmark):
        rows = mapped(rows, clean_rows, rows.schema, items=items, least=least)
    return rows.select(*[
        F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "item_id", "score")
