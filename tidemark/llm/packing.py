"""Best-fit packing: pieces of documents into sequences of a fixed number of tokens.

What fits together depends on lengths alone, of which there are at most as many as a
sequence has tokens. So the pieces of each length are counted, and the bins are planned from
these counts, however many pieces there are. The plan is minimum bin slack: a bin takes the
longest piece left, then a bitset subset-sum over the lengths still available finds the
fullest combination for the rest of it. As many bins of that kind are made as the counts
allow, the pieces are removed from the counts, and so on until none is left. One kind of bin
uses up at least one length (or leaves fewer than one bin needs), which bounds the plan.

Pieces get a rank among all pieces of their length: their rank within the task that cut
them, plus what earlier tasks cut of that length. A rank tells the bin, and the place in it.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, other_columns, parts, stored, table, with_row

CAPACITY = 4096

#: The id put after every document.
END_ID = 1

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Tokens ----------------------------------------------------------------------------

#: Words whose ids a worker remembers, and those of the first it keeps when it has too many.
_REMEMBERED, _KEPT = 800_000, 200_000

_MARKS = b".,!?;:|%$&*()"


class WordIds:
    """Token ids of texts, put together from the ids of their words.

    For tokenizers that drop white space and never join across it. A plain word with some
    punctuation after it is encoded in a row with others, in one call; the ids that end a
    word tell them apart. All other words are encoded one by one.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ending = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ending[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self.place: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self._remember([b""], np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _remember(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        first, last = len(self.place), len(self.place) + len(words)
        while last > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.begin[first:last] = self.used + np.cumsum(sizes) - sizes
        self.size[first:last] = sizes
        self.used += len(ids)
        self.place.update(zip(words, range(first, last), strict=True))

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, np.uint32) for f in found]

    def _learn(self, words: list[bytes]) -> None:
        plain, cores, marks, others = [], [], [], []
        for word in words:
            core = word.rstrip(_MARKS)
            if not core.isalpha():  # bytes.isalpha knows ASCII letters only
                letters = core.decode()
                if not (letters.isalpha() and letters.lower().isalpha()):
                    others.append(word)
                    continue
            plain.append(word)
            cores.append(core)
            marks.append(word[len(core) :])
        if plain:
            core_set, shapes = set(cores), list(set(marks))
            known = [c for c in core_set if c in self.place]  # met as words
            fresh = list(core_set.difference(known))
            at = np.fromiter(map(self.place.__getitem__, known), np.int64, len(known))
            core_ids, core_sizes = self._in_rows(fresh)
            found = self._encoded([s.decode() for s in shapes])
            flat = np.concatenate([
                _gathered(self.flat, self.begin[at], self.size[at]), core_ids, *found])
            sizes = np.concatenate([self.size[at], core_sizes, [len(f) for f in found]])
            begin = np.cumsum(sizes) - sizes
            number = dict(zip(known + fresh, range(len(core_set)), strict=True))
            mark = dict(zip(shapes, range(len(core_set), len(sizes)), strict=True))
            both = np.empty(2 * len(plain), np.int64)
            both[::2] = np.fromiter(map(number.__getitem__, cores), np.int64, len(plain))
            both[1::2] = np.fromiter(map(mark.__getitem__, marks), np.int64, len(plain))
            self._remember(plain, _gathered(flat, begin[both], sizes[both]),
                           sizes[both].reshape(-1, 2).sum(axis=1))
        if others:
            found = self._encoded([word.decode() for word in others])
            self._remember(others, np.concatenate(found), np.array([len(f) for f in found]))

    def _in_rows(self, cores: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain words one after another, and how many each has."""
        if not cores:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        rows = [cores[i : i + 500] for i in range(0, len(cores), 500)]
        ids, sizes = [], []
        joined = self._encoded([b" ".join(r).decode() for r in rows])
        for row, found in zip(rows, joined, strict=True):
            cuts = np.flatnonzero(self.ending[found]) + 1
            if len(cuts) == len(row):
                ids.append(found)
                sizes.append(np.diff(cuts, prepend=0))
            else:
                each = self._encoded([core.decode() for core in row])
                ids += each
                sizes.append(np.array([len(e) for e in each]))
        return np.concatenate(ids), np.concatenate(sizes)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        if len(self.place) > _REMEMBERED:
            self.place = dict(islice(self.place.items(), _KEPT))
            self.used = int(self.begin[_KEPT])
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = pa.array(texts, pa.large_binary()).view(pa.large_string())
        split = pc.ascii_split_whitespace(pc.if_else(
            pc.match_substring(whole, "<|"), whole, pc.ascii_lower(whole)))
        # A word is looked up once for all its places; white space at an end leaves an empty one.
        words = split.flatten().view(pa.large_binary()).dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = list(map(self.place.get, distinct))
        new = [w for w, place in zip(distinct, places, strict=True) if place is None]
        if new:
            self._learn(new)
            places = [self.place[w] if place is None else place
                      for w, place in zip(distinct, places, strict=True)]
        at = np.array(places, np.int64)[words.indices.to_numpy()]
        sizes = self.size[at]
        total = np.concatenate([[0], np.cumsum(sizes)])[split.offsets.to_numpy()]
        return _gathered(self.flat, self.begin[at], sizes), np.diff(total)


def _gathered(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of an array one after another."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return flat[:0].copy()
    return flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(ends[-1])]


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def document_ids(texts: list[bytes], path: str, end: int) -> list[np.ndarray]:
    """The ids of each text with the end id after them."""
    ids, counts = _word_ids(path).of(texts)
    out, at = [], 0
    for count in counts.tolist():
        out.append(np.append(ids[at : at + count], np.uint32(end)))
        at += count
    return out


def piece_rows(batches, path, capacity, end):
    part, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    for batch, data, offsets in parts(batches):
        texts = [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
        owner, piece, start, length, crc = [], [], [], [], []
        for row, ids in enumerate(document_ids(texts, path, end)):
            for number, at in enumerate(range(0, len(ids), capacity)):
                cut = ids[at : at + capacity]
                owner.append(row)
                piece.append(number)
                start.append(at)
                length.append(len(cut))
                crc.append(zlib.crc32(cut.astype("<u4").tobytes()))
        size = np.array(length)
        order = np.argsort(size, kind="stable")
        ranked = size[order]
        first = np.searchsorted(ranked, ranked, side="left")
        rank = np.empty(len(size), np.int64)
        rank[order] = np.arange(len(size)) - first + met[ranked]
        met += np.bincount(size, minlength=capacity + 1)
        yield pa.RecordBatch.from_arrays(
            [batch["row"].take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
             pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
             pa.array([part] * len(owner), pa.int32()), pa.array(rank)],
            names=["row", "piece", "start", "length", "ids_crc32", "part", "rank"])


# Plan ------------------------------------------------------------------------------


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best; ``counts`` says how many there are."""
    reach, steps, mask = 1, [], (1 << room + 1) - 1
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            wider = (reach | reach << take * length) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left -= take
            take *= 2
        if reach >> room:
            break
    filled, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> filled & 1:
            used[length] = used.get(length, 0) + take
            filled -= take * length
    return used


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Kinds of bins, as pieces of each length in one, and how many bins of each kind."""
    left, out = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        kind = fullest(left, capacity - longest)
        left[longest] += 1
        kind[longest] = kind.get(longest, 0) + 1
        copies = min(left[x] // n for x, n in kind.items())
        out.append((kind, copies))
        for x, n in kind.items():
            left[x] -= n * copies
            if not left[x]:
                del left[x]
    return out


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """For each kind of bin and length: the ranks it takes, sorted by length and rank."""
    rows, met, sequence = [], {}, 0
    for kind, copies in plan:
        offset = 0
        for length in sorted(kind, reverse=True):
            rows.append((length, met.get(length, 0), kind[length], sequence, offset))
            met[length] = met.get(length, 0) + kind[length] * copies
            offset += kind[length] * length
        sequence += copies
    cells = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "uses", "sequence", "offset"), cells.T, strict=True))


def placed_rows(batches, places):
    for batch in batches:
        if not batch.num_rows:
            continue
        length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
        # Both are below 2**40: one number orders by length, then rank.
        key = places["length"] * (1 << 40) + places["first"]
        at = np.searchsorted(key, length * (1 << 40) + rank, side="right") - 1
        past = rank - places["first"][at]
        uses = places["uses"][at]
        yield pa.RecordBatch.from_arrays(
            [*(batch[n] for n in ("row", "piece", "start", "length", "ids_crc32")),
             pa.array(places["sequence"][at] + past // uses),
             pa.array(places["offset"][at] + past % uses * length)],
            names=["row", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])


def pack(
    docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END_ID
) -> DataFrame:
    """One row per piece: ``row`` (the document's columns but the text), its place.

    Columns: piece, start, length, ids_crc32, sequence_id, offset. A document is its ids and
    the end id, so one with a null or empty text has length 1; only documents longer than
    ``capacity`` are cut. Repeated rows are documents of their own. An empty table has no
    pieces.
    """
    rows = docs.select(
        other_columns(docs, "text"),
        F.col("text").cast("string").alias("text"),
    )
    found = stored(mapped(rows, piece_rows, with_row(
        rows, "piece int, start long, length long, ids_crc32 long, part int, rank long"),
        path=path or tokenizer_path(), capacity=capacity, end=end), "pieces")
    tally = found.groupBy("part", "length").count()
    # At most ``capacity`` rows, whatever the size of the input.
    counts = {r["length"]: r["n"] for r in
              tally.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    earlier = tally.select(
        "part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    ranked = found.join(earlier, ["part", "length"]).withColumn(
        "rank", F.col("rank") + F.col("earlier")).drop("part", "earlier")
    return mapped(
        ranked.select("row", "piece", "start", "length", "ids_crc32", "rank"), placed_rows,
        with_row(rows, "piece int, start long, length long, ids_crc32 long, "
                       "sequence_id long, offset long"),
        places=_places(plan_bins(counts, capacity)))


def sequence_rows(batches, path, capacity, end):
    for batch, data, offsets in parts(batches):
        texts = [data[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
        owner, ids = [], []
        for number, (whole, pieces) in enumerate(zip(
                document_ids(texts, path, end), batch["pieces"].to_pylist(), strict=True)):
            for p in pieces:
                owner.append((number, p["sequence_id"], p["offset"]))
                ids.append(whole[p["start"] : p["start"] + p["length"]].astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[1] for o in owner], pa.int64()),
             pa.array([o[2] for o in owner], pa.int64()),
             pa.array(ids, pa.list_(pa.int32()))],
            names=["sequence_id", "offset", "ids"])


def sequences(
    docs: DataFrame, packed: DataFrame, path: str | None = None,
    capacity: int = CAPACITY, end: int = END_ID,
) -> DataFrame:
    """The packed sequences themselves (sequence_id, ids), from documents with unique ids."""
    pieces = packed.groupBy(F.col("row.doc_id").alias("doc_id")).agg(F.collect_list(
        F.struct("sequence_id", "offset", "start", "length")).alias("pieces"))
    ids = mapped(
        docs.select("doc_id", "text").join(pieces, "doc_id").select("text", "pieces"),
        sequence_rows, T.StructType.fromDDL("sequence_id long, offset long, ids array<int>"),
        path=path or tokenizer_path(), capacity=capacity, end=end)
    return ids.groupBy("sequence_id").agg(F.expr(
        "flatten(transform(array_sort(collect_list(struct(offset, ids))), p -> p.ids))"
    ).alias("ids"))


def packed_documents(docs: DataFrame) -> DataFrame:
    return pack(docs).select(F.col("row.doc_id").alias("doc_id"), "piece", "start", "length",
                             "ids_crc32", "sequence_id", "offset")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
