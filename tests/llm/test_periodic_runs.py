"""Periodic runs against looking at every period of every text."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tests.compare import connect, difference
from tidemark.llm import periodic_runs
from tidemark.llm.common import Sums

ODD = "doc_id long, text string, `a.b` string, row int, runs string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "dot", 1, "r") for i, t in rows], ODD)


def brute(words, least=24, periods=3):
    found = {}
    for period in range(1, len(words) // periods + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(least, periods * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(seed, count):
    draw = random.Random(seed)
    out = [None, "", " \n\t ", "é", "a " * 23, "a " * 24, "a b " * 12, ("a " * 30 + "b ") * 5,
           "\v".join(["x"] * 4000), "ab " * 30 + "c " * 30]
    for _ in range(count):
        words = [f"{draw.choice('wé字')}{draw.randint(0, draw.choice([1, 3, 40]))}"
                 for _ in range(draw.randint(0, 200))]
        if draw.random() < 0.6 and words:
            base = words[: draw.randint(1, 12)]
            at = draw.randrange(len(words))
            words[at:at] = (base * 20)[: draw.randint(5, 90)]
            if draw.random() < 0.3:
                words *= draw.randint(2, 4)
        out.append(draw.choice([" ", "\n", "  "]).join(words))
    return out


def test_runs_and_text_equal_brute_force(spark):
    texts = made(1, 150)
    rows = [(None if i % 20 == 3 else i // 2, t) for i, t in enumerate(texts)]
    found = periodic_runs.collapse_runs(documents(spark, rows).coalesce(2)).collect()
    want = []
    for i, text in rows:
        words = split(text)
        runs = brute(words)
        want.append((i, runs, collapsed(words, runs)))
    got = [(r["row"]["doc_id"], [tuple(x) for x in r["runs"]], r["text"]) for r in found]

    def order(row):
        return (row[0] is None, row[0] or 0, row[1], row[2])

    assert sorted(got, key=order) == sorted(want, key=order)
    assert sum(len(r[1]) for r in want) > 60
    assert {(r["row"]["a.b"], r["row"]["runs"]) for r in found} == {("dot", "r")}


@pytest.mark.parametrize("seed", range(6))
def test_many_texts_in_one_part(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(200):
        texts.append([draw.randint(0, draw.choice([0, 1, 2, 5])) for _ in range(draw.randint(0, 60))])
    numbers = np.array([w for t in texts for w in t], np.int64)
    owner = np.array([i for i, t in enumerate(texts) for _ in t], np.int64)
    for least, periods in ((3, 3), (6, 3), (12, 4)):
        start, end, period = periodic_runs.find_runs(numbers, owner, least, periods)
        got = list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))
        at, want = 0, []
        for words in texts:
            want += [(s + at, n, q) for s, n, q in brute(words, least, periods)]
            at += len(words)
        assert got == want


def test_the_grammar_leaves_no_pair_twice_and_uses_rules_once_searched():
    numbers = np.array(([1, 2, 3] * 40 + [9, 8] * 3) * 3, np.int64)
    grammar = periodic_runs.Grammar(numbers, np.zeros(len(numbers), np.int64), 24)
    assert grammar.count < 40 and len(grammar.rule) > grammar.count
    for rule, place in zip(grammar.rule, grammar.place, strict=True):
        length = grammar.high[rule] - grammar.low[rule]
        assert np.array_equal(
            numbers[place : place + length], numbers[grammar.low[rule] : grammar.high[rule]])


def test_hashes_that_agree_for_unequal_words_do_no_harm(monkeypatch):
    draw = random.Random(7)
    numbers = np.array([draw.randint(0, 1) for _ in range(300)] + [0, 1, 1] * 20, np.int64)
    want = brute(numbers.tolist(), 6)

    def weak(self, start, end):
        return (self.sums[end] - self.sums[start]) & np.uint64(0)

    monkeypatch.setattr(Sums, "of", weak)
    start, end, period = periodic_runs.find_runs(numbers, np.zeros(len(numbers), np.int64), 6)
    assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == want


def test_text_of_two_words_whose_stretches_have_equal_hashes():
    """Sums modulo 2**64 cannot tell the halves of this sequence apart; it has no run."""
    numbers = np.array([bin(i).count("1") & 1 for i in range(1 << 12)], np.int64)
    assert not len(periodic_runs.find_runs(numbers, np.zeros(len(numbers), np.int64))[0])


def test_empty_table(spark):
    assert periodic_runs.collapse_runs(documents(spark, [])).count() == 0


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_the_query_equals_brute_force_on_odd_rows(spark, tmp_path):
    rows = list(enumerate(made(8, 120))) + [(None, "a " * 40), (5, "b " * 40), (5, "b " * 40)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        words = split(text)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = brute(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        want.append((
            i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs))))
    found = [tuple(r) for r in periodic_runs.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_the_query_equals_its_sql(spark, sf_dir):
    found = difference(
        spark, connect(sf_dir), periodic_runs.op12_periodic_runs, periodic_runs.ORACLE_SQL, sf_dir)
    assert not found, found
