"""Document fingerprints: invertible Bloom lookup sketches of a document's paragraphs.

A text is cut into paragraphs: at line breaks, and within longer lines where the last few
bytes hash low, about every ``MEAN_BYTES``, so that an edit changes the pieces it touches and
no others. Each piece (the second of two equal ones is a piece of its own) is put into three
cells of a sketch; a cell holds the number of its pieces, the sum of their digests and the
sum of check digests. The sketches of two versions are subtracted cell by cell, which leaves
the pieces that differ, and these are peeled out of cells that hold just one. Where the cells
do not suffice, both texts are sketched with twice as many, until all is peeled. The numbers
of pieces, and of those peeled from either side, give the likeness (Jaccard, 0 to 1).

The fingerprint is the smallest sketch, spelled out; it depends on the text alone.

All sketches of a batch lie in one array, and are filled, subtracted and peeled together.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Sums, id_key, mapped, mix, other_columns, table, utf8, with_row

MEAN_BYTES = 16

#: Bytes that decide on a cut.
CONTEXT = 6

#: Cells of each third of the smallest sketch, which is the fingerprint.
THIRD = 6

_SALTS = np.array([0x51ED270B, 0x7C0FFEE5, 0x2545F491], np.uint64)
_CHECK = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def paragraph_digests(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digest and the owner of every paragraph of all texts, by owner."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = Sums(data)
    cut = data == 10
    rolled = sums.runs(CONTEXT)
    if len(rolled):
        low = np.concatenate([np.zeros(CONTEXT - 1, bool), rolled < np.uint64(2**64 // MEAN_BYTES)])
        for i in range(CONTEXT - 1):  # never by bytes of the text before
            early = offsets[:-1] + i
            low[early[early < len(low)]] = False
        cut |= low
    cut[offsets[1:][np.diff(offsets) > 0] - 1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    digests = mix(sums.of(starts, ends) + (ends - starts).astype(np.uint64) * _STEP)
    order = np.lexsort((digests, owner))
    digests, owner = digests[order], owner[order]
    fresh = np.ones(len(digests), bool)
    fresh[1:] = (digests[1:] != digests[:-1]) | (owner[1:] != owner[:-1])
    run = np.maximum.accumulate(np.where(fresh, np.arange(len(digests)), 0))
    again = (np.arange(len(digests)) - run).astype(np.uint64)
    return mix(digests + again * _CHECK), owner


class Sketches:
    """Sketches side by side: sketch i has three thirds of ``thirds[i]`` cells."""

    def __init__(self, thirds: np.ndarray):
        self.thirds = thirds.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(3 * self.thirds)])
        cells = int(self.base[-1])
        self.count = np.zeros(cells, np.int64)
        self.digest = np.zeros(cells, np.uint64)
        self.check = np.zeros(cells, np.uint64)

    def add(self, digests: np.ndarray, owner: np.ndarray, sign: np.ndarray) -> None:
        """Put pieces in (sign 1) or take them out (sign -1)."""
        signed = sign.astype(np.uint64)
        marks = mix(digests ^ _CHECK)
        third = self.thirds[owner]
        for i, salt in enumerate(_SALTS):
            place = mix(digests + salt) % third.astype(np.uint64)
            cell = self.base[owner] + i * third + place.astype(np.int64)
            np.add.at(self.count, cell, sign)
            np.add.at(self.digest, cell, digests * signed)
            np.add.at(self.check, cell, marks * signed)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each sketch: pieces with sign 1, pieces with sign -1, and whether all came out."""
        counts = len(self.thirds)
        plus, minus = np.zeros(counts, np.int64), np.zeros(counts, np.int64)
        sketch = np.repeat(np.arange(counts), 3 * self.thirds)
        while True:
            lone = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[lone]
            digests = self.digest[lone] * sign.astype(np.uint64)
            pure = mix(digests ^ _CHECK) * sign.astype(np.uint64) == self.check[lone]
            if not pure.any():
                break
            owner, digests, sign = sketch[lone[pure]], digests[pure], sign[pure]
            order = np.lexsort((digests, owner))
            owner, digests, sign = owner[order], digests[order], sign[order]
            first = np.ones(len(owner), bool)
            first[1:] = (owner[1:] != owner[:-1]) | (digests[1:] != digests[:-1])
            owner, digests, sign = owner[first], digests[first], sign[first]
            self.add(digests, owner, -sign)
            plus += np.bincount(owner[sign > 0], minlength=counts)
            minus += np.bincount(owner[sign < 0], minlength=counts)
        stuck = (self.count != 0) | (self.digest != 0) | (self.check != 0)
        return plus, minus, np.bincount(sketch[stuck], minlength=counts) == 0


def _of_pairs(digests, owner, wanted, pair):
    """The pieces of the texts ``wanted``, with the number of the pair each is for."""
    first = np.searchsorted(owner, wanted, side="left")
    size = np.searchsorted(owner, wanted, side="right") - first
    ends = np.cumsum(size)
    at = np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
    return digests[at], np.repeat(pair, size)


def likeness(ours, others, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
    """Likeness of text mine[i] of ``ours`` to text theirs[i] of ``others`` (digests, owner)."""
    def sizes(side, wanted):
        return (np.searchsorted(side[1], wanted, "right")
                - np.searchsorted(side[1], wanted, "left"))

    n1, n2 = sizes(ours, mine), sizes(others, theirs)
    # A first guess: a quarter of the pieces differ.
    thirds = np.maximum(THIRD, (n1 + n2) // 8 + 1)
    out, left = np.ones(len(mine)), np.arange(len(mine))
    while len(left):
        sketches, pair = Sketches(thirds[left]), np.arange(len(left))
        for side, wanted, sign in ((ours, mine, 1), (others, theirs, -1)):
            digests, owner = _of_pairs(*side, wanted[left], pair)
            sketches.add(digests, owner, np.full(len(owner), sign, np.int64))
        plus, _, done = sketches.peel()
        good = left[done]
        both = n1[good] - plus[done]
        union = n1[good] + n2[good] - both
        out[good] = np.where(union > 0, both / np.maximum(union, 1), 1.0)
        left = left[~done]
        thirds[left] *= 2
    return out


def spelled(digests: np.ndarray, owner: np.ndarray, texts: int) -> list[str]:
    """The fingerprint of each text."""
    sketches = Sketches(np.full(texts, THIRD))
    sketches.add(digests, owner, np.ones(len(owner), np.int64))
    cells = np.rec.fromarrays(
        [sketches.count.astype("<i4"), sketches.digest.astype("<u8"),
         sketches.check.astype("<u4")]).view(np.uint8).reshape(texts, -1)
    return [base64.b64encode(c.tobytes()).decode() for c in cells]


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as many characters of the one that follows."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def fingerprint_rows(batches, most):
    """Sorted by bucket, copies of later heads last, then order: each with the row after it."""
    held = None
    for batch in batches:
        data, offsets = utf8(batch["text"])
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            taken = batch.slice(at, end - at)
            whole = taken if held is None else pa.Table.from_batches(
                [held, taken]).combine_chunks().to_batches()[0]
            found = _fingerprinted(whole)
            if found is not None:
                yield found
            held = whole.slice(whole.num_rows - 1, 1)
            at = end


def _fingerprinted(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    bucket, guest = batch["bucket"].to_numpy(), batch["guest"].to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((bucket[:-1] == bucket[1:]) & ~guest[:-1])
    if not len(rows):
        return None
    texts = [t or "" for t in batch["text"].to_pylist()]
    changed = [edited(texts[i], texts[i + 1]) for i in rows.tolist()]
    own = paragraph_digests(*utf8(pa.array(texts, pa.string())))
    new = paragraph_digests(*utf8(pa.array(changed, pa.string())))
    number = np.arange(len(rows))
    prints, new_prints = spelled(*own, len(texts)), spelled(*new, len(rows))
    return pa.RecordBatch.from_arrays(
        [batch["row"].take(pa.array(rows)),
         pa.array([len(texts[i]) for i in rows.tolist()], pa.int64()),
         pa.array(changed, pa.string()),
         pa.array([prints[i] for i in rows.tolist()]), pa.array(new_prints),
         pa.array(likeness(own, new, rows, number)),
         pa.array(likeness(own, own, rows, rows + 1))],
        names=["row", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited",
               "near_next"])


# Neighbours ------------------------------------------------------------------------


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the descending bounds lie above the key, in two short searches."""
    step = max(1, round(len(bounds) ** 0.5))
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not rows:
        return F.lit(0)

    def above(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b > key))

    row = above(F.array(*[F.lit(r[-1]) for r in rows]))
    last = F.element_at(F.array(*[F.array(*map(F.lit, r)) for r in rows]), row + 1)
    return F.when(row < len(rows), row * step + above(last)).otherwise(F.lit(len(bounds)))


def with_following(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, guest, row, text) so sorted that each is followed by the next document.

    Documents go by descending id, then text hash; the first follows the last, and one without
    an id comes first. Buckets are ranges of ids. Into each a copy of the head of the next one
    is put, marked as a guest; there are as many heads as buckets. Of documents that share a
    head's id all are copied, and the first counts. Texts are shuffled once.
    """
    rows = docs.select(
        other_columns(docs, "text"), id_key().alias("k"),
        F.col("text").cast("string").alias("text"))
    cuts = rows.select(F.percentile_approx(
        "k", F.array(*[F.lit(i / buckets) for i in range(1, buckets)]) if buckets > 1
        else F.array(F.lit(0.5)), 10 * buckets).alias("cuts")).first()["cuts"] or []
    bounds = sorted(set(cuts), reverse=True)
    placed = rows.withColumn("bucket", _bucket(F.col("k"), bounds)).withColumn(
        "th", F.xxhash64(F.coalesce("text", F.lit(""))))
    heads = sorted((r["bucket"], r["head"]) for r in placed.groupBy("bucket").agg(
        F.max("k").alias("head")).collect())
    if not heads:
        return placed.withColumn("guest", F.lit(False)).drop("k", "th")
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}
    back = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    copies = F.when(F.col("k").isin(list(before)), F.array(
        F.struct("bucket", F.lit(False).alias("guest")),
        F.struct(F.element_at(back, F.col("k")).alias("bucket"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct("bucket", F.lit(False).alias("guest"))))
    spread = placed.withColumn("copy", F.explode(copies)).select(
        "copy.bucket", "copy.guest", "k", "th", "row", "text")
    return spread.repartition("bucket").sortWithinPartitions(
        "bucket", "guest", F.desc("k"), F.desc("th")).drop("k", "th")


def fingerprint(docs: DataFrame, buckets: int | None = None, most: int = 1 << 19) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), fingerprints, likenesses.

    Columns: n_chars, edited (the edited text), fingerprint, edited_fingerprint, near_edited,
    near_next. A null text is empty; two empty texts are alike (1). A document alone is its
    own next one. Repeated rows are documents of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = with_following(docs, buckets)
    return mapped(ordered, fingerprint_rows, with_row(
        ordered, "n_chars long, edited string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double"), most=most)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")
