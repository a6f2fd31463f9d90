"""Suffix-array dedup: bytes covered by a long string that occurred earlier are removed.

The suffixes of all texts are put in order only as far as ``WINDOW`` bytes, by passes from
the most significant digit on; groups that are equal to that depth are exactly the repeated
windows. A pass drops every group of one, and so few suffixes reach the next.

1. First digit: ``GRAM`` bytes. Not every suffix takes part, but one in each stretch: of the
   grams in a window, the first one with the lowest hash is its anchor. Equal windows have
   equal anchors at equal places, so that a repeated window has a repeated anchor. (A window
   of 100 bytes has 85 grams; about one suffix in 43 is an anchor.) Anchors whose gram occurs
   once are dropped.
2. Second digit: all that the windows around the anchor can hold. Of anchors that agree in it
   every window of the later ones is a repeat, and only the first goes on; an anchor whose
   gram has no other surroundings is done.
3. Last digit: the windows themselves. For each place of the anchor in a window, the rest of
   the window orders the anchors of a gram; of equal ones all but the first are repeats. Grams
   with more than ``CROWD`` surroundings are split by their windows over all tasks instead.

A repeat is checked byte by byte in the last pass, and by 128 bits of hash in the second.
Order is by document id, then start. The covered bytes of each document are then cut out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Sums, binary, discard, id_key, mapped, mix, other_columns, parts, stored, table, with_row,
)

WINDOW = 100
GRAM = 16

#: Grams with more different surroundings than this are split by window.
CROWD = 50_000

#: Surroundings worked on at once in the last pass.
AT_ONCE = 4096

#: A stretch to cut is one number: its start (which may lie before the text), then its size.
_SIZE_BITS = 16


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    count = len(values) - width + 1
    pad = -len(values) % width
    cells = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)])
    rows = cells.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, offsets: np.ndarray, sums: Sums, window: int, gram: int):
    """The places of the anchors of all windows, and the hashes of the grams there."""
    hashes = sums.runs(gram)
    width = window - gram + 1
    if len(hashes) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    limit = np.repeat(offsets[1:], np.diff(offsets))
    start = np.arange(len(data) - window + 1)
    start = start[start + window <= limit[: len(start)]]  # windows do not cross texts
    least = _sliding_least(hashes, width)[start]
    # From one window to the next the anchor stays, unless its hash changes or it drops out.
    new = np.ones(len(start), bool)
    new[1:] = (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1) | (
        hashes[start[1:] - 1] == least[1:])
    start, least = start[new], least[new]
    places, left = np.zeros(len(start), np.int64), np.arange(len(start))
    for step in range(width):
        here = hashes[start[left] + step] == least[left]
        places[left[here]] = start[left[here]] + step
        left = left[~here]
        if not len(left):
            break
    places = np.unique(places)
    return places, hashes[places]


def anchor_rows(batches, window, gram):
    """First digit, second digit and place of every anchor.

    Within a part the second of two equal surroundings is a repeat for certain; it is told by
    a negative place, under a digit of its own, so that it burdens no group. The anchors of a
    repeated row are the same places once more, and go.
    """
    before = window - gram
    for batch, data, offsets in parts(batches):
        sums = Sums(data)
        place, first = anchors(data, offsets, sums, window, gram)
        owner = np.searchsorted(offsets, place, side="right") - 1
        left = np.minimum(place - offsets[owner], before)
        right = np.minimum(offsets[owner + 1] - place, window)
        shape = (left * (window + 1) + right).astype(np.uint64)
        second = mix(sums.of(place - left, place + right) + shape * np.uint64(0x9E3779B97F4A7C15))
        k, h = (batch[c].to_numpy()[owner] for c in ("k", "h"))
        at = place - offsets[owner]
        order = np.lexsort((at, h, k, second, first))
        rows = np.stack([first[order].view(np.int64), second[order].view(np.int64), k[order],
                         h[order], at[order]])
        fresh = np.ones(len(first), bool)  # a repeated row of the table is no second anchor
        fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        first, second, k, h, at = rows[:, fresh]
        again = np.zeros(len(first), bool)
        again[1:] = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        own = mix(mix(k.view(np.uint64) ^ mix(at.view(np.uint64))) ^ h.view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(again, own, first)), pa.array(second),
             pa.array(k), pa.array(h), pa.array(np.where(again, -1 - at, at))], names=_NAMES)


_NAMES = ["gram", "around", "k", "h", "at"]


def repeat_rows(batches):
    """Of anchors sorted by both digits and place: certain repeats (gram 0, ``whole``), and
    the first of each surroundings where a gram has several."""
    held, joined, previous = None, False, None
    for batch in batches:
        rows = np.stack([batch[c].to_numpy() for c in _NAMES])
        certain = rows[-1] < 0
        early = rows[:, certain]
        early[-1] = -1 - early[-1]
        rows = rows[:, ~certain]
        if previous is not None:
            rows = np.concatenate([previous, rows], axis=1)
        if not rows.shape[1]:
            yield from _marked(early, True)
            continue
        same = np.zeros(rows.shape[1], bool)
        same[1:] = (rows[:2, 1:] == rows[:2, :-1]).all(axis=0)
        twin = np.zeros(rows.shape[1], bool)  # a repeated row of the table
        twin[1:] = (rows[:, 1:] == rows[:, :-1]).all(axis=0)
        if previous is not None:
            same[0] = twin[0] = True  # it was dealt with before
        fresh = ~same
        # A twin of an anchor is the same place once more, and no repeat of it.
        yield from _marked(np.concatenate([early, rows[:, same & ~twin]], axis=1), True)
        previous = rows[:, -1:]
        firsts = rows[:, fresh]
        if held is not None:
            firsts = np.concatenate([held, firsts], axis=1)
        if not firsts.shape[1]:
            continue
        near = firsts[0, 1:] == firsts[0, :-1]
        kept = np.concatenate([near, [False]])
        kept[1:] |= near
        kept[0] |= joined
        joined, held = bool(kept[-1]), firsts[:, -1:]
        kept[-1] = False
        yield from _marked(firsts[:, kept], False)
    if joined:
        yield from _marked(held, False)


def _marked(rows: np.ndarray, whole: bool):
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.zeros_like(rows[0]) if whole else rows[0]), *map(pa.array, rows[2:]),
         pa.array(np.full(rows.shape[1], whole))], names=["gram", "k", "h", "at", "whole"])


def surrounding_rows(batches, window, gram):
    """For each marked anchor of a text the bytes around it, padded to one length."""
    before, width = window - gram, 2 * window - gram
    for batch, data, offsets in parts(batches):
        marks = batch["marks"]
        sizes = pc.list_value_length(marks).to_numpy()
        flat = marks.flatten()
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        at, digit = flat.field("at").to_numpy(), flat.field("gram")
        place = offsets[owner] + at
        left = np.minimum(place - offsets[owner], before)
        right = np.minimum(offsets[owner + 1] - place, window)
        step = 1 << 14
        for i in range(0, len(place), step):
            s = slice(i, i + step)
            column = place[s, None] + np.arange(-before, window)
            column = np.clip(column, 0, len(data) - 1)
            yield pa.RecordBatch.from_arrays(
                [digit[i : i + step], batch["k"].take(pa.array(owner[s])),
                 batch["h"].take(pa.array(owner[s])), pa.array(at[s]),
                 pa.array(left[s].astype(np.int32)), pa.array(right[s].astype(np.int32)),
                 binary(data[column].reshape(-1, width))],
                names=["gram", "k", "h", "at", "before", "after", "around"])


def _cells(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["around"].to_pylist()), np.uint8).reshape(-1, width)


def _window_hashes(cells: np.ndarray, window: int, places: int) -> np.ndarray:
    """For each row the hash of the window that begins at each of its first ``places``."""
    count, width = cells.shape
    out = np.zeros((count, places), np.uint64)
    for i in range(0, count, AT_ONCE):
        block = cells[i : i + AT_ONCE]
        start = (np.arange(len(block)) * width)[:, None] + np.arange(places)
        out[i : i + AT_ONCE] = mix(Sums(block.ravel()).of(start, start + window))
    return out


def covered_rows(batches, window, gram):
    """Rows sorted by gram and place: the stretches whose windows are repeats."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < AT_ONCE:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        grams = whole["gram"].to_numpy()
        cut = int(np.searchsorted(grams, grams[-1], side="left"))  # the last may go on
        held = [whole.slice(cut)]
        if cut:
            yield _covered(whole.slice(0, cut), window, gram)
    if held:
        yield _covered(pa.Table.from_batches(held).combine_chunks().to_batches()[0], window, gram)


def _covered(batch: pa.RecordBatch, window: int, gram: int) -> pa.RecordBatch:
    places = window - gram + 1
    cells = _cells(batch, 2 * window - gram)
    grams = batch["gram"].to_numpy().view(np.uint64)
    before, after = batch["before"].to_numpy(), batch["after"].to_numpy()
    hashes = _window_hashes(cells, window, places)
    repeated = np.zeros(hashes.shape, bool)
    for i in range(places):  # the anchor is at places - 1 - i in the window
        shift = places - 1 - i
        rows = np.flatnonzero((shift <= before) & (window - shift <= after))
        key = mix(hashes[rows, i] ^ mix(grams[rows]))
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = np.zeros(len(rows), bool)
        same[1:] = ranked[1:] == ranked[:-1]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
        own, earliest = rows[order[same]], rows[order[first[same]]]
        equal = (cells[own, i : i + window] == cells[earliest, i : i + window]).all(axis=1)
        repeated[own[equal], i] = True
    return _stretches(batch, repeated, window, places)


def _stretches(batch, repeated, window, places) -> pa.RecordBatch:
    edge = np.zeros((len(repeated), 1), np.int8)
    turns = np.diff(np.concatenate([edge, repeated.view(np.int8), edge], axis=1), axis=1)
    row, begin = np.nonzero(turns == 1)
    _, end = np.nonzero(turns == -1)
    place = batch["at"].to_numpy()[row]
    start = place - (places - 1) + begin
    size = place - places + end + window - start
    return pa.RecordBatch.from_arrays(
        [batch["k"].take(pa.array(row)), batch["h"].take(pa.array(row)),
         pa.array((start << _SIZE_BITS) + size)], names=["k", "h", "cut"])


def window_rows(batches, window, gram):
    """Of crowded grams: every window as a row of its own, told by 128 bits."""
    places = window - gram + 1
    for whole in batches:
        for i in range(0, whole.num_rows, 512):
            batch = whole.slice(i, 512)
            cells = _cells(batch, 2 * window - gram)
            one = _window_hashes(cells, window, places)
            two = _window_hashes(cells[:, ::-1], window, places)[:, ::-1]
            shift = places - 1 - np.arange(places)
            good = (shift <= batch["before"].to_numpy()[:, None]) & (
                window - shift <= batch["after"].to_numpy()[:, None])
            row, column = np.nonzero(good)
            at = batch["at"].to_numpy()[row] - shift[column]
            yield pa.RecordBatch.from_arrays(
                [pa.array(one[good].view(np.int64)), pa.array(two[good].view(np.int64)),
                 batch["k"].take(pa.array(row)), batch["h"].take(pa.array(row)), pa.array(at)],
                names=["w1", "w2", "k", "h", "at"])


def cut_rows(batches):
    for batch in batches:
        kept, size, removed, spans = [], [], [], []
        for text, cuts in zip(batch["text"].to_pylist(), batch["cuts"].to_pylist(), strict=True):
            data = np.frombuffer((text or "").encode(), np.uint8)
            size.append(len(data))
            if not cuts:
                kept.append(data.tobytes())
                removed.append(0)
                spans.append(0)
                continue
            edges = np.zeros(len(data) + 1, np.int64)
            cuts = np.array(cuts, np.int64)
            start = cuts >> _SIZE_BITS
            stop = start + (cuts & ((1 << _SIZE_BITS) - 1))
            np.add.at(edges, np.maximum(start, 0), 1)
            np.add.at(edges, np.minimum(stop, len(data)), -1)
            gone = np.cumsum(edges[:-1]) > 0
            kept.append(data[~gone].tobytes())
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(kept, pa.binary()), *(
                pa.array(x, pa.int64()) for x in (size, removed, spans))],
            names=["row", "kept", "n_bytes", "n_removed", "n_spans"])


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), kept (bytes), n_bytes,
    n_removed, n_spans (runs of removed bytes).

    A byte goes if a string of ``window`` bytes that covers it also starts earlier: in a
    document with a smaller id, or earlier in its own. Documents that share an id follow by a
    64-bit hash of their texts, which also tells them apart; repeated rows are one document, and its result is repeated. One
    without an id comes last. A null text is empty. An empty table gives no rows.
    """
    given = docs.select(
        other_columns(docs, "text"), id_key().alias("k"),
        F.col("text").cast("string").alias("text"))
    shared_ids = not given.groupBy("k").count().where("count > 1").isEmpty()
    # Rows that share an id are told apart by 64 bits of their texts, in a column of their own.
    h = F.xxhash64(F.coalesce("text", F.lit(""))) if shared_ids else F.lit(0).cast("long")
    texts, keys = given.withColumn("h", h), ["k", "h"]
    marks = stored(mapped(
        mapped(texts.select("k", "h", "text"), anchor_rows,
               "gram long, around long, k long, h long, at long", window=window, gram=gram)
        .repartition("gram").sortWithinPartitions(*_NAMES),
        repeat_rows, "gram long, k long, h long, at long, whole boolean"), "marks")
    several = marks.where("NOT whole")
    # At most one in CROWD marks: few enough to be sent to every task, so that no surroundings move
    # to be told apart by them.
    crowded = stored(
        several.groupBy("gram").count().where(F.col("count") > CROWD).select("gram"), "crowded")
    wanted = several.select("k", "h", F.struct("gram", "at").alias("mark")).groupBy(*keys).agg(
        F.collect_list("mark").alias("marks"))
    met = texts.select("k", "h", "text").join(wanted, keys)
    if shared_ids:
        met = met.dropDuplicates(keys)
    around = stored(mapped(
        met.select("k", "h", "text", "marks"), surrounding_rows,
        "gram long, k long, h long, at long, before int, after int, around binary",
        window=window, gram=gram), "around", "zstd")
    few = mapped(
        around.join(F.broadcast(crowded), "gram", "left_anti").repartition("gram")
        .sortWithinPartitions("gram", "k", "h", "at"), covered_rows,
        "k long, h long, cut long", window=window, gram=gram)
    windows = mapped(
        around.join(F.broadcast(crowded), "gram", "left_semi"), window_rows,
        "w1 long, w2 long, k long, h long, at long", window=window, gram=gram)
    # Stored, so that the join can split a window that very many anchors share.
    firsts = stored(windows.groupBy("w1", "w2").agg(
        F.min(F.struct("k", "h", "at")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n"), "firsts")
    many = windows.join(firsts, ["w1", "w2"]).where(
        F.struct("k", "h", "at") > F.col("first")).select(
        "k", "h", (F.shiftleft("at", _SIZE_BITS) + window).alias("cut")).distinct()
    before = window - gram
    whole = marks.where("whole").select("k", "h", (
        F.shiftleft(F.col("at") - before, _SIZE_BITS) + before + window).alias("cut"))
    # Stored, so that what led to them is off the disks before the texts move once more.
    cuts = stored(whole.unionByName(few).unionByName(many).groupBy(*keys).agg(
        F.collect_list("cut").alias("cuts")), "cuts")
    discard(marks, crowded, around, firsts)
    rows = texts.join(cuts, keys, "left")
    return mapped(rows.select("row", "text", "cuts"), cut_rows, with_row(
        rows, "kept binary, n_bytes long, n_removed long, n_spans long"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))
