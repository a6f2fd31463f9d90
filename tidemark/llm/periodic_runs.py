"""Periodic run detection on a grammar: Re-Pair the words, look at each rule's boundary once.

A run is a maximal stretch of words that repeats with a smallest period at least three times.
The words of a text are compressed by Re-Pair, in rounds that handle all texts of a part at once:
a round replaces each text's most frequent pair of symbols, and with it every pair that outranks
those it overlaps, until no pair occurs twice. What is left of a text is bound together by
balanced rules.

A run lies inside the expansion of some rule and crosses the boundary of the rule's two halves.
So each rule, however often it is used, is searched once, around its boundary; what is found is
translated to all places the rule was put in, and of the intervals of one period those inside
another are dropped. Stretches are compared by their hashes; what comes out is compared word by
word before it counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    Sums, mapped, mix, other_columns, parts, spread_values, table, with_row, words,
)

#: Words of a run at least, and periods it holds at least.
LEAST_WORDS = 24
LEAST_PERIODS = 3

#: Pairs of a boundary and a period looked at together.
_TOGETHER = 1 << 20

_NONE = np.zeros(0, np.int64)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words have equal ones."""
    if not len(starts):
        return _NONE
    sizes = np.concatenate(([0], np.cumsum(ends - starts)))
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    solid = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(sizes), pa.py_buffer(solid)])
    return pc.dictionary_encode(found).indices.to_numpy().astype(np.int64)


# Grammar -------------------------------------------------------------------------


def _doubled(left: np.ndarray, right: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Pairs of equal symbols that overlap the pair before them in a stretch of one symbol."""
    equal = (left == right) & same
    if not equal.any():
        return equal
    place = np.arange(len(equal))
    began = np.maximum.accumulate(np.where(equal, -1, place))
    return equal & ((place - began) % 2 == 0)


def _repeated_pairs(symbols, owner):
    """Places of pairs that occur twice in their text, with the number of their group.

    Most pairs occur once; a count by a small hash leaves them out before anything is sorted.
    """
    left, right = symbols[:-1], symbols[1:]
    same = owner[:-1] == owner[1:]
    open_ = same & ~_doubled(left, right, same)
    size = 1 << max(10, int(len(symbols)).bit_length() + 1)
    cell = (mix(
        (left.astype(np.uint64) << np.uint64(32)) ^ right.astype(np.uint64)
        ^ (owner[:-1].astype(np.uint64) << np.uint64(20))) & np.uint64(size - 1)).astype(np.int64)
    counts = np.bincount(cell[open_], minlength=size)
    places = np.flatnonzero(open_ & (counts[cell] >= 2))
    key = (left[places] << 32) | right[places]
    order = np.argsort(key, kind="stable")
    key, places = key[order], places[order]
    fresh = np.ones(len(places), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[places[1:]] != owner[places[:-1]])
    return places, np.cumsum(fresh) - 1


def _chosen(count: int, places: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs to replace: those of higher rank (count, then number) than both they overlap."""
    size = np.bincount(group)
    rank = size * len(size) + np.arange(len(size), 0, -1) - 1
    rank[size < 2] = -1
    ranks = np.full(count + 2, -1, np.int64)
    ranks[places + 1] = rank[group]
    own = ranks[places + 1]
    wins = (own >= 0) & (own > ranks[places]) & (own > ranks[places + 2])
    places, group = places[wins], group[wins]
    twice = np.bincount(group, minlength=len(size))[group] >= 2
    return places[twice], group[twice]


class Grammar:
    """Rules of the texts of one part, as stretches of word places.

    ``low``, ``cut`` and ``high`` bound each rule's first expansion and its two halves; ``rule``
    and ``place`` say where each rule was put in.
    """

    def __init__(self, numbers: np.ndarray, owner: np.ndarray, least: int):
        self.low, self.cut, self.high = [], [], []
        self.rule, self.place, self.count = [], [], 0
        self.least, self._words = least, len(numbers)
        self._bind(*self._compress(numbers, owner))
        for name in ("low", "cut", "high", "rule", "place"):
            setattr(self, name, np.concatenate([_NONE, *getattr(self, name)]))

    def _add(self, low, cut, high, group, places):
        """Rules long enough to hold a run."""
        long = high - low >= self.least
        number = np.cumsum(long) - 1 + self.count
        used = long[group]
        self.rule.append(number[group[used]])
        self.place.append(places[used])
        for name, values in (("low", low), ("cut", cut), ("high", high)):
            getattr(self, name).append(values[long])
        self.count += int(long.sum())

    def _compress(self, symbols, owner):
        """Rounds of replacement; the places and owners of the symbols left."""
        place = np.arange(len(symbols))
        end = place + 1
        done, fresh = [], int(symbols.max(initial=-1)) + 1
        while len(symbols) > 1:
            places, group = _chosen(len(symbols) - 1, *_repeated_pairs(symbols, owner))
            if not len(places):
                break
            _, first, group = np.unique(group, return_index=True, return_inverse=True)
            at = places[first]
            self._add(place[at], place[at + 1], end[at + 1], group, place[places])
            symbols = symbols.copy()
            symbols[places] = fresh + group
            fresh += len(first)
            end[places] = end[places + 1]
            kept = np.ones(len(symbols), bool)
            kept[places + 1] = False
            changed = np.zeros(int(owner[-1]) + 1, bool)
            changed[owner[places]] = True
            going = changed[owner]
            done.append((place[kept & ~going], owner[kept & ~going]))
            kept &= going
            symbols, owner, place, end = symbols[kept], owner[kept], place[kept], end[kept]
        done.append((place, owner))
        places, owners = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(places)
        return places[order], owners[order]

    def _bind(self, place, owner):
        """Balanced rules over what is left of each text."""
        if not len(place):
            return
        count = int(owner[-1]) + 1
        low = np.searchsorted(owner, np.arange(count))
        high = np.searchsorted(owner, np.arange(count), side="right")
        ends = np.append(place, self._words)
        while len(low):
            long = (high - low > 1) & (ends[high] - ends[low] >= self.least)
            low, high = low[long], high[long]
            cut = (low + high) // 2
            self._add(ends[low], ends[cut], ends[high], np.arange(len(low)), ends[low])
            low, high = np.concatenate((low, cut)), np.concatenate((cut, high))


# Runs ----------------------------------------------------------------------------


def _agreeing(sums: Sums, first, second, most, back: bool) -> np.ndarray:
    """How far (at most ``most``) the words from two places on are equal, or those before them."""
    low, high = np.zeros(len(first), np.int64), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_] + 1) // 2
        a, b = first[open_], second[open_]
        if back:
            equal = sums.of(a - mid, a) == sums.of(b - mid, b)
        else:
            equal = sums.of(a, a + mid) == sums.of(b, b + mid)
        low[open_[equal]] = mid[equal]
        high[open_[~equal]] = mid[~equal] - 1


def _stretches(numbers, sums, low, cut, high, period):
    """Start and end of the stretches with these periods around these boundaries.

    A run of three periods across a boundary has two whole ones next to it on one side, or one
    on each. Each row is one period of one boundary; the rows that hold a run come back with it.
    """
    rows, starts, ends = [], [], []
    for back in (0, 1, 2):
        # Words from ``at`` on are compared with those a period later.
        at = cut - period * back if back else cut
        fits = np.flatnonzero((at >= low) & (at + 2 * period <= high))
        fits = fits[numbers[at[fits]] == numbers[at[fits] + period[fits]]]
        a, q = at[fits], period[fits]
        equal = sums.of(a, a + q) == sums.of(a + q, a + 2 * q)
        fits, a, q = fits[equal], a[equal], q[equal]
        ahead = _agreeing(sums, a + q, a + 2 * q, high[fits] - a - 2 * q, False)
        behind = _agreeing(sums, a, a + q, a - low[fits], True)
        rows.append(fits)
        starts.append(a - behind)
        ends.append(a + 2 * q + ahead)
    return tuple(np.concatenate(x) for x in (rows, starts, ends))


def _holds(numbers: np.ndarray, start: int, end: int, period: int) -> bool:
    return np.array_equal(numbers[start : end - period], numbers[start + period : end])


def _plain_runs(numbers: np.ndarray, low: int, high: int, least: int, periods: int):
    """The runs of a stretch of words, each period by itself."""
    for period in range(1, (high - low) // periods + 1):
        equal = numbers[low : high - period] == numbers[low + period : high]
        edges = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
        for start, end in zip(edges[::2], edges[1::2]):
            if end - start + period >= max(least, periods * period):
                yield low + int(start), low + int(end) + period, period


def _smallest(start, end, period, *groups) -> np.ndarray:
    """The rows that have the smallest period of all with their start, end and group."""
    order = np.lexsort((period, end, start, *groups))
    fresh = np.ones(len(order), bool)
    if len(order):
        fresh[1:] = False
        for values in (start, end, *groups):
            fresh[1:] |= values[order][1:] != values[order][:-1]
    return order[fresh]


def _crossing(numbers, sums, low, cut, high, first, least, periods):
    """Rule, start, end and period of the runs across the boundaries of some rules."""
    counts = (high - low) // periods
    rule = np.repeat(np.arange(len(low)), counts)
    period = np.arange(len(rule)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    rows, start, end = _stretches(numbers, sums, low[rule], cut[rule], high[rule], period)
    rule, period = rule[rows], period[rows]
    kept = (end - start >= np.maximum(least, periods * period)) & (start < cut[rule]) & (end > cut[rule])
    rule, start, end, period = (x[kept] for x in (rule, start, end, period))
    kept = _smallest(start, end, period, rule)
    found = [tuple(x[kept] for x in (rule, start, end, period))]
    wrong = {int(r) for r, *run in zip(*found[0], strict=True) if not _holds(numbers, *run)}
    if wrong:
        # Unequal words with equal hashes: these rules are searched without any.
        right = ~np.isin(found[0][0], list(wrong))
        found = [tuple(x[right] for x in found[0])]
        for r in wrong:
            runs = list(_plain_runs(numbers, int(low[r]), int(high[r]), least, periods))
            if runs:
                found.append((np.full(len(runs), r), *map(np.array, zip(*runs))))
    rule, start, end, period = (np.concatenate(x) for x in zip(*found))
    return rule + first, start, end, period


def find_runs(
    numbers: np.ndarray, owner: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of the texts, by place.

    ``numbers`` has the words of all texts one after another, ``owner`` the text of each.
    """
    grammar = Grammar(numbers, owner, least)
    sums = Sums(numbers, spread_values(int(numbers.max(initial=-1)) + 1, 77))
    found = [(_NONE, _NONE, _NONE, _NONE)]
    work = np.cumsum((grammar.high - grammar.low) // periods)
    at = 0
    while at < grammar.count:
        done = work[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(work, done + _TOGETHER, side="right")))
        cuts = slice(at, to)
        found.append(_crossing(
            numbers, sums, grammar.low[cuts], grammar.cut[cuts], grammar.high[cuts], at, least,
            periods))
        at = to
    rule, start, end, period = (np.concatenate(x) for x in zip(*found))
    # Every place of a rule gets the rule's runs.
    order = np.argsort(grammar.rule, kind="stable")
    uses, places = grammar.rule[order], grammar.place[order]
    low = np.searchsorted(uses, rule)
    counts = np.searchsorted(uses, rule, side="right") - low
    run = np.repeat(np.arange(len(rule)), counts)
    use = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts) + low[run]
    moved = places[use] - grammar.low[rule[run]]
    start, end, period = start[run] + moved, end[run] + moved, period[run]
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = end + period * (len(numbers) + 1)
    before = np.concatenate(([-1], np.maximum.accumulate(reach)[:-1]))[: len(reach)]
    whole = reach > before
    start, end, period = start[whole], end[whole], period[whole]
    kept = _smallest(start, end, period)
    order = kept[np.lexsort((period[kept], start[kept]))]
    return start[order], end[order], period[order]


# Rows ----------------------------------------------------------------------------


def _kept_text(data, offsets, starts, ends, owner, kept):
    """The kept words of each text with one space between them."""
    starts, ends, owner = starts[kept], ends[kept], owner[kept]
    inner = np.zeros(len(owner), bool)
    inner[:-1] = owner[1:] == owner[:-1]
    sizes = ends - starts + inner
    marks = np.zeros(len(data) + 2, np.int8)
    marks[starts] += 1
    marks[ends + inner] -= 1
    data = data.copy()
    data[ends[inner]] = 32
    inside = np.cumsum(marks[:-2], dtype=np.int8).view(bool)
    places = np.zeros(len(offsets), np.int64)
    np.cumsum(np.bincount(owner, sizes, len(offsets) - 1), out=places[1:])
    return pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1,
        [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[inside]))])


def run_rows(batches, least, periods):
    for batch, data, offsets in parts(batches):
        starts, ends, owner = words(data, offsets)
        start, end, period = find_runs(word_numbers(data, starts, ends), owner, least, periods)
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        kept = np.cumsum(change[:-1]) == 0
        text = _kept_text(data, offsets, starts, ends, owner, kept)
        first = np.searchsorted(owner, np.arange(batch.num_rows))
        of = owner[start] if len(start) else _NONE
        runs = pa.StructArray.from_arrays(
            [pa.array(start - first[of]), pa.array(end - start), pa.array(period)],
            names=["start", "length", "period"])
        places = np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.ListArray.from_arrays(pa.array(places), runs), text.cast(pa.string())],
            names=["row", "runs", "text"])


def collapse_runs(
    docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS
) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), its ``runs`` and its ``text``.

    A run (start, length, period; counted in words, sorted by start and period) is a stretch with
    this smallest period, of ``least`` words and ``periods`` periods or more, that no neighbouring
    word continues. The text keeps the words that no run holds after its first period, with one
    space between them. Null and empty texts have no run and an empty text. Every row is looked at
    by itself, so repeated rows and rows without an id give results of their own; an empty table
    gives no rows. A text is worked on whole, however long.
    """
    rows = docs.select(other_columns(docs, "text"), F.col("text").cast("string").alias("text"))
    return mapped(
        rows, run_rows,
        with_row(rows, "runs array<struct<start:long,length:long,period:long>>, text string"),
        least=least, periods=periods)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by a hash of its id, ends in a repeated stretch of words."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return (
        docs.withColumn("_h", hashed).withColumn("_words", F.expr(
            r"""IF(_h % 10 = 0, filter(split(text, '[ \\t\\n\\x0B\\f\\r]+'), w -> w <> ''), NULL)"""))
        .withColumn("_n", F.size("_words")).withColumn("_g", F.expr("_h DIV 10"))
        .withColumn("_a", F.expr("IF(_n > 0, CAST(_g % _n AS INT), 0)"))
        .withColumn("_p", F.expr("CAST(1 + (_n - _a) DIV (3 + _g % 8) AS INT)"))
        .withColumn("text", F.expr("""IF(_n > 0, array_join(concat(
            slice(_words, 1, _a), slice(flatten(array_repeat(
                slice(_words, _a + 1, _p), CAST((_n - _a) DIV _p + 1 AS INT))), 1, _n - _a)), ' '), text)"""))
        .drop("_h", "_words", "_n", "_g", "_a", "_p"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = collapse_runs(with_planted_runs(docs)).withColumn("best", F.expr("""
        get(array_sort(runs, (a, b) -> CASE
            WHEN a.length * b.period > b.length * a.period THEN -1
            WHEN a.length * b.period < b.length * a.period THEN 1
            WHEN a.start <> b.start THEN IF(a.start < b.start, -1, 1)
            WHEN a.period <> b.period THEN IF(a.period < b.period, -1, 1) ELSE 0 END), 0)"""))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period AS exponent_milli"),
        F.expr("""sha2(array_join(transform(runs,
            r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), ''), 256) AS runs_sha256"""),
        F.sha2("text", 256).alias("collapsed_sha256"))


# Words of equal text a period apart, in stretches without a break, for every period.
ORACLE_SQL = r"""
WITH hashed AS (
    SELECT doc_id, text, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: list_prepend(
            CAST(ascii(ch) AS BIGINT),
            list_transform(range(8), lambda bit: CAST(-1 AS BIGINT)))))),
        lambda sum, x: CASE WHEN x >= 0 THEN xor(sum, x)
            ELSE xor(sum >> 1, (sum & 1) * 3988292384) END)) AS h
    FROM documents
), split AS (
    SELECT doc_id, h, h // 10 AS g, list_filter(
        regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda w: w <> '') AS ws
    FROM hashed
), measured AS (
    SELECT *, len(ws) AS n, CASE WHEN len(ws) > 0 THEN g % len(ws) END AS a FROM split
), periodic AS (
    SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM measured
), texts AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(
        range(n), lambda i: ws[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE ws END AS ws
    FROM periodic
), word AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM texts
), pairs AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x
    JOIN word y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i
    JOIN texts t ON t.doc_id = x.doc_id AND 3 * (y.i - x.i) <= t.n
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (
        SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs)
    GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(24, 3 * q)
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), collapsed AS (
    SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS text
    FROM word w ANTI JOIN dropped d ON d.doc_id = w.doc_id AND d.i = w.i GROUP BY w.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
        first({'start': start, 'length': length, 'period': period}
            ORDER BY CAST(length AS DECIMAL(38, 18)) / period DESC, start, period) AS best
    FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, l.best.start AS start, l.best.length AS length,
    l.best.period AS period, CAST(1000 * l.best.length // l.best.period AS BIGINT) AS exponent_milli,
    sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN collapsed c ON c.doc_id = d.doc_id
"""
