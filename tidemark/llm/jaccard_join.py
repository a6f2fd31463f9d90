"""N-gram Jaccard join: documents whose shingle sets are within a distance, in components.

The join works on distinct sets (classes); documents with equal sets are one class.

**Regions.** Among random texts every document lies at distance one of nearly every other,
so documents as pivots of the whole space part nothing. The pivots of the first level are
therefore patterns of parts of the shingle universe. Two sets within the distance differ in
at most D shingles, where D follows from their size. The universe is cut into more than D
slices by hash; restricted to a slice the distance is still a metric, and by the pigeonhole
principle the two sets lie at distance zero in one slice at least. A region is all sets with
one pattern in one slice; the windows that the triangle inequality asks for are the D + 1
slices, for the set's own size class and for the next smaller one. Sets that nearly agree
hence share a region, and unlike sets almost never do. There are some slices more than D + 1,
so that linked sets agree in several, and every set leaves out as many of its most crowded regions
as it can spare: what sets that only share a well-known passage would meet in.

**Within a region** classes are joined recursively and exactly. The class that shares most
regions is the pivot; the distance of every other class to it is computed from the texts.
What lies within the distance joins its component. A region whose members are all in one
component is done. In the others the next class becomes the pivot, for those not yet in its
component; after ``PIVOTS`` pivots, all pairs left in a region are compared that are in
different components, of fitting size, and whose distances to one pivot differ by no more
than the distance asked for (triangle inequality). No pair is left out: whenever two classes
are to be compared, only bounds spare the comparison, those above and one more. Parities of
the shingles in 512 cells are a sketch of a set; two sketches differ in no more bits than the
sets differ in shingles, so that pairs whose sketches lie too far apart are not within the
distance. Unlike sets differ in about half of the cells, which tells them apart while the distance
allows fewer shingles than that. Larger sets have a wide sketch too, with two to four cells a
shingle, which pairs are held against before any text moves; a wider one is folded to a
narrower one's cells by adding up its halves.

Equal sets never meet in pairs, and links within a component are not all made: the result
is each document's component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LAST_ID, LOWER, discard, id_key, mapped, mix, other_columns, parts, shingles, stored, table,
    word_hashes, words,
)

WIDTH = 3

#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 90

#: Pivots tried in a region before what is left of it is compared pair by pair.
PIVOTS = 2

#: Members compared with one copy of a pivot.
FAN_OUT = 500

#: A set's sketch: so many words of 64 parities.
SKETCH = 8

#: Sets of more shingles have a wide sketch too.
WIDE_FROM = 256

#: Slices beyond those that the distance asks for, at most: as many regions a set can spare.
MOST_SPARE = 64

_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles (hashes) of every text and their owners, sorted by both.

    A text with fewer words than the width has one shingle, its whole sequence of words.
    """
    low = LOWER[data]
    starts, ends, owner = words(low, offsets)
    hashes = word_hashes(low, starts, ends)
    found, of = shingles(hashes, owner, width)
    count = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    for size in range(1, width):
        texts = np.flatnonzero(count == size)
        if len(texts):
            short = np.full(len(texts), size, np.uint64)
            for i in range(size):
                short = mix(short * np.uint64(5) + hashes[first[texts] + i] + np.uint64(i))
            found, of = np.concatenate([found, short]), np.concatenate([of, texts])
    order = np.lexsort((found, of))
    found, of = found[order], of[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
    return found[fresh], of[fresh]


def _summed(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Sums modulo 2**64 of values by group; groups are sorted."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    cuts = np.searchsorted(group, np.arange(groups + 1))
    return total[cuts[1:]] - total[cuts[:-1]]


def set_keys(found: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that tell sets apart."""
    return (_summed(mix(found ^ _FIRST), of, texts), _summed(mix(found ^ _SECOND), of, texts))


def sketches(found: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """For each set, of its shingles in each of 64 * SKETCH cells whether they are odd."""
    cells = np.zeros(texts * 64 * SKETCH, np.uint8)
    at = mix(found ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(40)
    np.add.at(cells, of * 64 * SKETCH + (at % np.uint64(64 * SKETCH)).astype(np.int64), 1)
    return np.packbits(cells & 1).view(np.int64).reshape(texts, SKETCH)


def wide_sketches(found: np.ndarray, of: np.ndarray, texts: int) -> list[bytes | None]:
    """Parities of the larger sets' shingles in 2 ** b cells, at least two a shingle.

    The cell is the low bits of a hash, so that a sketch of half the cells is the sum of a
    sketch's halves.
    """
    cuts = np.searchsorted(of, np.arange(texts + 1))
    cells = mix(found ^ np.uint64(0x632BE59BD9B4E019))
    out: list[bytes | None] = [None] * texts
    for i in np.flatnonzero(np.diff(cuts) > WIDE_FROM):
        own = cells[cuts[i] : cuts[i + 1]]
        size = 1 << int(2 * len(own) - 1).bit_length()
        odd = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
        out[i] = np.packbits(odd.astype(np.uint8)).tobytes()
    return out


def bits_apart(one: bytes, other: bytes) -> int:
    """In how many cells two wide sketches differ, the wider one folded."""
    a, b = (np.frombuffer(x, np.uint8) for x in (one, other))
    if len(a) < len(b):
        a, b = b, a
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


class SizeClasses:
    """Ranges of set sizes; linked sets lie in one or in neighbouring ones."""

    def __init__(self, percent: int, most: int = 1 << 34):
        self.percent = percent
        first = [1]
        while first[-1] < most:
            first.append(first[-1] * 100 // percent + 1)
        self.first = np.array(first, np.int64)
        last = self.first[1:] - 1
        # 100 * both >= percent * union bounds the difference of the sets.
        self.differ = (last + last * 100 // percent) * (100 - percent) // (100 + percent)
        # Linked sets agree in one slice more than are spare.
        spare = np.where(self.differ < 4, 0, np.clip(self.differ // 3, 1, MOST_SPARE))
        self.slices = self.differ + 1 + spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, sizes, side="right") - 1


def regions(
    found: np.ndarray, of: np.ndarray, texts: int, classes: SizeClasses
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every region of every text, with the text, its size class and what it can spare.

    Texts that only equal sets could be linked with have none. Linked sets agree in ``certain``
    slices at least, of which those can be empty that are so in both. A set with fewer empty
    ones has no regions for these; of its others it can spare so many that one they agree in
    is left, whichever are taken (the last number's low byte, the class above it).
    """
    size = np.bincount(of, minlength=texts)
    own = classes.of(size)
    keys, owners, spares = [], [], []
    spread = mix(found ^ np.uint64(0xA5A5A5A5))
    marks = mix(found ^ np.uint64(0x5BD1E995))
    for step in (0, 1):
        family = own - step
        good = (size > 0) & (family >= 0)
        good[good] &= classes.differ[family[good]] > 0
        slices = np.where(good, classes.slices[np.maximum(family, 0)], 0)
        base = np.cumsum(slices) - slices
        inside = good[of]
        cell = base[of[inside]] + (
            (spread[inside] >> np.uint64(32)) * slices[of[inside]].astype(np.uint64)
            >> np.uint64(32)).astype(np.int64)
        total = int(slices.sum())
        order = np.argsort(cell, kind="stable")
        pattern = _summed(marks[inside][order], cell[order], total)
        held = np.bincount(cell, minlength=total)
        owner = np.repeat(np.arange(texts), slices)
        number = np.arange(total) - base[owner]
        # Sets that agree in empty slices alone have more of them than there are to spare.
        empty = np.bincount(owner, held == 0, texts)
        certain = slices - classes.differ[np.maximum(family, 0)]
        kept = (held > 0) | (empty >= certain)[owner]
        place = (family[owner].astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64)
        keys.append(mix(pattern + mix(place))[kept])
        owners.append(owner[kept])
        spare = np.maximum(certain - empty.astype(np.int64) - 1, 0)
        spares.append(((family << 8) + spare)[owner[kept]])
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(spares)


def _sketch(letter: str) -> list[str]:
    return [f"{letter}{i}" for i in range(SKETCH)]


def class_rows(batches, width):
    for batch, data, offsets in parts(batches):
        texts = batch.num_rows
        found, of = shingle_sets(data, offsets, width)
        first, second = set_keys(found, of, texts)
        yield pa.RecordBatch.from_arrays(
            [batch["k"], batch["th"], pa.array(np.bincount(of, minlength=texts)),
             pa.array(first.view(np.int64)), pa.array(second.view(np.int64)),
             *map(pa.array, sketches(found, of, texts).T),
             pa.array(wide_sketches(found, of, texts), pa.binary())],
            names=["k", "th", "n", "c1", "c2", *_sketch("s"), "wide"])


def region_rows(batches, width, percent):
    """Regions with the key of the set; a set met before in the task is not repeated."""
    classes, met = SizeClasses(percent), set()
    for batch, data, offsets in parts(batches):
        found, of = shingle_sets(data, offsets, width)
        first, second = set_keys(found, of, batch.num_rows)
        if len(met) > 200_000:
            met.clear()
        new = np.zeros(batch.num_rows, bool)
        for i, key in enumerate(zip(first.tolist(), second.tolist(), strict=True)):
            if key not in met:
                met.add(key)
                new[i] = True
        inside = new[of]
        key, owner, spare = regions(found[inside], of[inside], batch.num_rows, classes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(first.view(np.int64)[owner]),
             pa.array(second.view(np.int64)[owner]), pa.array(spare.astype(np.int64))], names=_REGION)


_REGION = ["region", "c1", "c2", "spare"]


def shared_rows(batches):
    """Of rows sorted by region and set: those of regions with several sets, each once."""
    held, joined = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch[c].to_numpy() for c in _REGION])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        fresh = np.ones(rows.shape[1], bool)
        fresh[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        rows = rows[:, fresh]
        same = rows[0, 1:] == rows[0, :-1]
        kept = np.concatenate([same, [False]])
        kept[1:] |= same
        kept[0] |= joined
        joined, held = bool(kept[-1]), rows[:, -1:]
        kept[-1] = False
        yield pa.RecordBatch.from_arrays(
            [pa.array(r[kept]) for r in rows], names=_REGION)
    if joined:
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in held], names=_REGION)


def without_spare(shared: DataFrame) -> DataFrame:
    """Regions and sets, without the most crowded regions that each set can spare.

    All sets put regions in one order, by how many sets they hold. Of the regions that two
    linked sets agree in, the least crowded has at least as many above it as are certain but for
    one, and so neither set spares it. A passage that many documents share crowds few of a
    document's regions, and these go.
    """
    crowds = shared.groupBy("region").agg(F.count("*").alias("crowd"))
    order = Window.partitionBy("c1", "c2", F.shiftright("spare", 8)).orderBy(
        F.desc("crowd"), F.desc("region"))
    ranked = shared.join(crowds.hint("merge"), "region").withColumn("at", F.row_number().over(order))
    kept = ranked.where(F.col("at") > F.col("spare").bitwiseAND(255)).select("region", "c1", "c2")
    several = kept.groupBy("region").agg(F.count("*").alias("crowd")).where("crowd > 1")
    return kept.join(several.select("region").hint("merge"), "region", "left_semi")


def compared_rows(batches, width):
    """Sorted by pivot, salt and kind: the pivot's text, then its members' texts."""
    pivot, current = None, None
    for batch, data, offsets in parts(batches):
        found, of = shingle_sets(data, offsets, width)
        cuts = np.searchsorted(of, np.arange(batch.num_rows + 1))
        a, b, both, na, nb = [], [], [], [], []
        for i, (kind, node, at) in enumerate(zip(
                batch["kind"].to_pylist(), batch["node"].to_pylist(),
                batch["pivot"].to_pylist(), strict=True)):
            own = found[cuts[i] : cuts[i + 1]]
            if kind == 0:
                pivot, current = at, own
                continue
            if pivot != at:
                raise ValueError("a pivot's text is missing")
            a.append(node)
            b.append(at)
            both.append(len(np.intersect1d(own, current, assume_unique=True)))
            na.append(len(own))
            nb.append(len(current))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (a, b, both, na, nb)],
            names=["a", "b", "both", "na", "nb"])


def near_rows(batches, percent):
    """Pairs whose wide sketches, where both have one, do not rule out that they are linked."""
    for batch in batches:
        kept = []
        for n, m, one, other in zip(*(batch[c].to_pylist() for c in ("n", "m", "wide", "wide2")),
                                    strict=True):
            kept.append(one is None or other is None or bits_apart(one, other) * (100 + percent)
                        <= (n + m) * (100 - percent))
        mask = pa.array(kept, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch["a"].filter(mask), batch["b"].filter(mask)], names=["a", "b"])


def not_ruled_out(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) left after their wide sketches have been held against each other."""
    one = nodes.select(F.col("node").alias("a"), "n", "wide")
    other = nodes.select(
        F.col("node").alias("b"), F.col("n").alias("m"), F.col("wide").alias("wide2"))
    both = pairs.join(one.hint("merge"), "a").join(other.hint("merge"), "b")
    return mapped(both.select("a", "b", "n", "m", "wide", "wide2"), near_rows, "a long, b long",
                  percent=percent)


def compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets and of what both have."""
    fans = pairs.groupBy("b").agg(F.ceil(F.count("*") / FAN_OUT).alias("fans"))
    salted = stored(pairs.join(fans, "b").select(
        F.col("a").alias("node"), F.col("b").alias("pivot"),
        F.pmod(F.xxhash64("a"), F.col("fans")).alias("salt")), "pairs")
    members = salted.hint("merge").join(texts, "node").select(
        "pivot", "salt", F.lit(1).alias("kind"), "node", "text")
    pivots = salted.select("pivot", "salt").distinct().join(
        texts.withColumnRenamed("node", "pivot"), "pivot").select(
        "pivot", "salt", F.lit(0).alias("kind"), F.col("pivot").alias("node"), "text")
    rows = members.unionByName(pivots).repartition("pivot", "salt").sortWithinPartitions(
        "pivot", "salt", "kind")
    found = stored(mapped(
        rows, compared_rows, "a long, b long, both long, na long, nb long", width=width),
        "compared")
    discard(salted)
    return found


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to (node, component), the component being its smallest node.

    Large and small stars in turn: each round ties every node to the smallest node it knows,
    until nothing changes, which takes a logarithm of the longest chain.
    """
    tied = stored(links.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        "ties")
    state = None
    while True:
        now = tied.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return tied.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
        both = tied.unionByName(tied.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large, before = stored(large, "ties"), tied
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"))
        tied = stored(small.distinct(), "ties")
        discard(before, large)


def _linked(found: DataFrame, percent: int) -> DataFrame:
    return found.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both")))


def _open(members: DataFrame, tied: DataFrame) -> DataFrame:
    """Members with their component, of regions that have several."""
    placed = members.drop("component").join(tied, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    several = placed.groupBy("region").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return stored(placed.join(several.select("region"), "region", "left_semi"), "open")


def _other(drawn: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the size and sketch of their pivot."""
    return rows.join(drawn.select(
        F.col("node").alias("pivot"), F.col("n").alias("m"),
        *[F.col(a).alias(b) for a, b in zip(_sketch("s"), _sketch("t"), strict=True)]), "pivot")


def _fits(percent: int):
    """What the sizes and sketches of two linked sets satisfy."""
    apart = sum(
        (F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
         for a, b in zip(_sketch("s"), _sketch("t"), strict=True)), F.lit(0))
    return (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (
        apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent))


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, pivots: int = PIVOTS
) -> DataFrame:
    """One row per document: k, th, n_shingles, first (k and th of the component's first).

    ``k`` is the id (``LAST_ID`` for none) and ``th`` a hash of the text. Texts without words
    (null or empty too) have no shingles and are linked with nothing: ``first`` is their own.
    Rows that share an id are kept apart by their texts; repeated rows give repeated results.
    An empty table gives no rows.
    """
    texts = docs.select(
        id_key().alias("k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sets = stored(mapped(
        texts, class_rows, "k long, th long, n long, c1 long, c2 long, "
        + ", ".join(f"{c} long" for c in _sketch("s")) + ", wide binary", width=width), "sets")
    classes = stored(sets.where("n > 0").groupBy("c1", "c2").agg(
        F.min(F.struct("k", "th")).alias("first"), F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in (*_sketch("s"), "wide")])
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    shared = stored(mapped(
        mapped(texts.select("text"), region_rows, "region long, c1 long, c2 long, spare long",
               width=width, percent=percent)
        .repartition("region").sortWithinPartitions("region", "c1", "c2"),
        shared_rows, "region long, c1 long, c2 long, spare long"), "shared")
    shared, every = stored(without_spare(shared).distinct(), "regions"), shared
    discard(every)
    ways = shared.groupBy("c1", "c2").agg(F.count("*").alias("ways"))
    nodes = stored(classes.join(ways, ["c1", "c2"]), "nodes")
    order = Window.partitionBy("region").orderBy(F.desc("ways"), "node")
    members = stored(
        shared.join(nodes.select("c1", "c2", "node", "n", "ways").hint("merge"), ["c1", "c2"])
        .withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("pivot", F.first("node").over(order))
        .select("region", "rank", "node", "n", "pivot", F.col("node").alias("component")),
        "members")
    drawn = nodes.select("node", "n", *_sketch("s"))
    wanted = nodes.select("node", "first.k", "first.th")
    # Shuffled at every size: what is wanted grows with the input.
    own = stored(texts.join(wanted.hint("merge"), ["k", "th"]).dropDuplicates(["node"]).select(
        "node", "text"), "texts")

    links, known, tied, left = None, None, None, members
    for turn in range(pivots + 1):
        last = turn == pivots
        if turn == 0:
            met = left.where("rank > 0").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
        else:
            near = left.select("region", "node", "component", "rank")
            far = left.select("region", F.col("node").alias("pivot"),
                              F.col("component").alias("other"), F.col("rank").alias("at"))
            if last:  # here sketches are looked at before pairs are made
                near, far = near.join(drawn, "node"), _other(drawn, far)
            met = near.join(far.where(f"at {'>=' if last else '='} {turn}"), "region").where(
                "rank > at AND component <> other")
            met = (met.where(_fits(percent)) if last else met).select(
                F.col("node").alias("a"), F.col("pivot").alias("b"))
        pairs = met.distinct()
        if not last:
            pairs = _other(drawn, pairs.withColumnRenamed("b", "pivot").join(
                drawn.withColumnRenamed("node", "a"), "a")).where(_fits(percent)).select(
                "a", F.col("pivot").alias("b"))
        if known is not None:
            pairs = pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")
            if last:
                pairs = _within_windows(pairs, known, percent)
        candidates = stored(pairs, "candidates")
        pairs = stored(not_ruled_out(candidates, nodes, percent), "near")
        discard(candidates)
        if not pairs.isEmpty():
            found = compared(pairs, own, width)
            known = found if known is None else known.unionByName(found)
            more = _linked(found, percent).select("a", "b")
            links = more if links is None else links.unionByName(more)
            tied = components(links)
        if tied is not None and not last:
            left = _open(left, tied)
            if left.isEmpty():
                break
    firsts = nodes.select("c1", "c2", "node", F.col("first").alias("own"))
    if tied is None:
        firsts = firsts.select("c1", "c2", F.col("own").alias("best"))
    else:
        placed = firsts.join(tied, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        best = placed.groupBy("component").agg(F.min("own").alias("best"))
        firsts = placed.join(best, "component").select("c1", "c2", "best")
    named = stored(classes.join(firsts, ["c1", "c2"], "left").select(
        "c1", "c2", F.coalesce("best", "first").alias("best")), "named")
    return sets.where("n > 0").join(named.hint("merge"), ["c1", "c2"]).select(
        "k", "th", F.col("n").alias("n_shingles"), F.col("best").alias("first"),
    ).unionByName(sets.where("n = 0").select(
        "k", "th", F.col("n").alias("n_shingles"), F.struct("k", "th").alias("first")))


def _within_windows(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Without pairs whose known distances to one pivot differ by more than the distance."""
    gone = known.select("a", "b", (
        F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("near"))
    first = pairs.join(gone.select("a", F.col("b").alias("p"), F.col("near").alias("x")), "a")
    second = gone.select(F.col("a").alias("b"), F.col("b").alias("p"), F.col("near").alias("y"))
    apart = first.join(second, ["b", "p"]).where(
        F.abs(F.col("x") - F.col("y")) > 1 - percent / 100 + 1e-9)
    return pairs.join(apart.select("a", "b").distinct(), ["a", "b"], "left_anti")


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Of each component the document with the smallest id; documents without words stay."""
    found = jaccard_components(docs, width, percent).groupBy("k", "th").agg(
        F.first("first").alias("first"), F.first("n_shingles").alias("n"))
    kept = found.where("n = 0 OR (first.k = k AND first.th = th)").select("k", "th", "n")
    rows = docs.select(
        other_columns(docs), id_key().alias("k"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    again = Window.partitionBy("k", "th").orderBy(F.lit(1))
    return rows.join(kept.hint("merge"), ["k", "th"]).withColumn("again", F.row_number().over(again)).where(
        "again = 1 OR n = 0").select("row.*")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def number(key: str):
        return F.nullif(F.col(key), F.lit(LAST_ID))

    return jaccard_components(table(spark, sf_dir, "documents")).select(
        number("k").alias("doc_id"), "n_shingles", number("first.k").alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1),
            lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g
    FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * common >= 90 * (na.n + nb.n - common)
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles,
    least(w.doc_id, coalesce(least.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = w.doc_id
"""
