"""Quality classifier: a document's own evidence, and that of its host and path.

1. Words and beginnings of words that set labelled documents apart are picked by their
   counts (G squared), and two logistic models (low quality, toxic) are fitted on these and
   on a few shares of characters and words. They are fitted on a bounded sample of labelled rows, ``SAMPLE``.
2. Every document is scored by both models.
3. Scores are summed by path (source and language) and host (source). A host's rate is
   shrunk toward the rate of all documents, a path's toward its host's; how far is told by
   the spread of the rates themselves (empirical Bayes, method of moments). Sparse sites
   hence keep the prior.
4. A document's odds are its own, times how the odds of its path's other documents differ from
   those of all.

A document is rejected where either posterior reaches one half.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    LOWER, mapped, other_columns, parts, stored, table, with_row, word_hashes, words,
)

#: Labelled rows the models are fitted on, at most; those with the lowest hashes of their id.
SAMPLE = 20_000

#: Words and beginnings picked for each model.
PICKED = 256

#: Bytes of the beginnings of longer words.
BEGINNINGS = (4, 5)

#: A word's G squared must be well over what chance gives, and the rate of the documents that
#: hold it so many times the rate of all. Words that speak against a target tell little but
#: how long a document is.
LEAST_SURPRISE, LEAST_LIFT = 18.0, 3.0

#: A word must be in so many labelled documents.
LEAST_DOCUMENTS = 4

TARGETS = ("low", "toxic")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: ASCII other than letters parts words.
_GAPS = np.ones(256, bool)
_GAPS[65:91] = _GAPS[97:123] = False
_GAPS[128:] = False
_SYMBOL = _GAPS.copy()
_SYMBOL[[9, 10, 13, 32, 44, 46]] = False

SHARES = 9


def _distinct(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[first], owner[first]


def _text_words(data, offsets):
    low = LOWER[data]
    starts, ends, owner = words(low, offsets, _GAPS)
    return low, starts, ends, owner


def _evidence(low, starts, ends, owner) -> tuple[np.ndarray, np.ndarray]:
    """Each word and each beginning of a word of every text, once, with its owner."""
    found, owners = [word_hashes(low, starts, ends)], [owner]
    for size in BEGINNINGS:
        long = ends - starts > size
        found.append(word_hashes(low, starts[long], starts[long] + size) + np.uint64(size))
        owners.append(owner[long])
    return _distinct(np.concatenate(found), np.concatenate(owners))


def shares(data, offsets, low, starts, ends, owner) -> np.ndarray:
    """Per text: shares of symbols, capitals and digits, and how its words repeat."""
    count = len(offsets) - 1
    size = np.diff(offsets)

    def summed(marked):
        total = np.concatenate([[0], np.cumsum(marked)])
        return total[offsets[1:]] - total[offsets[:-1]]

    hashes = word_hashes(low, starts, ends)
    total = np.bincount(owner, minlength=count)
    distinct = np.bincount(_distinct(hashes, owner)[1], minlength=count)
    echo = np.zeros(len(owner), bool)
    echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    bytes_, words_ = np.maximum(size, 1), np.maximum(total, 1)
    return np.stack([
        np.ones(count), summed(_SYMBOL[data]) / bytes_, summed(_UPPER[data]) / bytes_,
        summed(_DIGIT[data]) / bytes_, summed(data == 10) / bytes_, distinct / words_,
        np.bincount(owner, echo, count) / words_,
        np.bincount(owner, ends - starts, count) / words_ / 10, np.log1p(total) / 10,
    ], axis=1)


def label_words(batches):
    """The words of labelled documents, each once a document, with the labels."""
    for batch, data, offsets in parts(batches):
        hashes, owner = _evidence(*_text_words(data, offsets))
        owner = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes.view(np.int64)), batch["low"].take(owner),
             batch["toxic"].take(owner)], names=["word", "low", "toxic"])


def _features(data, offsets, picked) -> np.ndarray:
    count = len(offsets) - 1
    found = _text_words(data, offsets)
    out = np.zeros((count, SHARES + len(picked)), np.float32)
    out[:, :SHARES] = shares(data, offsets, *found)
    if len(picked):
        hashes, owner = _evidence(*found)
        at = np.searchsorted(picked, hashes)
        at[at == len(picked)] = 0
        hit = picked[at] == hashes
        out[owner[hit], SHARES + at[hit]] = 1
    return out


def feature_rows(batches, picked):
    for batch, data, offsets in parts(batches):
        cells = _features(data, offsets, picked)
        yield pa.RecordBatch.from_arrays(
            [batch["low"], batch["toxic"],
             pa.array([c.astype(np.float16).tobytes() for c in cells], pa.binary())],
            names=["low", "toxic", "features"])


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = 0.03, rounds: int = 15) -> np.ndarray:
    """Weights of a logistic model, by Newton steps; the first column is the constant.

    The other shares are brought to one spread before they are penalised.
    """
    spread = np.ones(x.shape[1])
    if len(y):
        spread[1:SHARES] = np.maximum(x[:, 1:SHARES].std(axis=0), 1e-3)
    x = x / spread
    weights = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():  # one class only: its rate, smoothed
        rate = (y.sum() + 0.5) / (len(y) + 50) if len(y) else 0.01
        weights[0] = np.log(rate / (1 - rate))
        return weights
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty * weights)
        weights += step
        if np.abs(step).max() < 1e-4:
            break
    return weights / spread


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The picked words and the weights of both models."""
    chosen = stored(
        labels.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.col("quality") == 0).cast("int").alias("low"), F.col("toxic").cast("int"),
        ).where("doc_id IS NOT NULL AND low IS NOT NULL AND toxic IS NOT NULL")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "low", "toxic").limit(sample), "labels")
    texts = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.col("text").cast("string").alias("text"))
        .join(chosen, "doc_id").select("text", "low", "toxic"), "labelled")
    total = texts.agg(F.count("*").alias("n"), F.sum("low").alias("low"),
                      F.sum("toxic").alias("toxic")).first()
    counted = stored(
        mapped(texts, label_words, "word long, low int, toxic int").groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("low").alias("low"), F.sum("toxic").alias("toxic"))
        .where(F.col("n") >= LEAST_DOCUMENTS), "words")
    picked = set()
    for target in TARGETS:
        if not total["n"] or not 0 < total[target] < total["n"]:
            continue
        rate = total[target] / total["n"]
        # Odds, so that words can be picked however common the target is.
        best = counted.where(
            F.col(target) * (1 - rate) >= LEAST_LIFT * rate * (F.col("n") - F.col(target))
        ).select("word", _surprise(F.col(target), F.col("n"), rate).alias("g"))
        picked |= {r["word"] for r in
                   best.where(F.col("g") >= LEAST_SURPRISE).orderBy(F.desc("g"), "word").limit(PICKED).collect()}
    words_ = np.sort(np.array(sorted(picked), np.int64).view(np.uint64))
    # At most ``sample`` rows of about a kilobyte.
    rows = mapped(texts, feature_rows, "low int, toxic int, features binary",
                  picked=words_).toArrow()
    width = SHARES + len(words_)
    cells = np.frombuffer(b"".join(rows["features"].to_pylist()), np.float16)
    x = cells.reshape(-1, width).astype(np.float64)
    return {"picked": words_} | {
        t: fitted(x, np.array(rows[t].to_pylist(), np.float64)) for t in TARGETS}


def _surprise(hits: Column, n: Column, rate: float) -> Column:
    """G squared of ``hits`` among ``n`` against the rate of all."""
    def term(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (term(hits, n * rate) + term(n - hits, n * (1 - rate)))


def score_rows(batches, model):
    for batch, data, offsets in parts(batches):
        cells = _features(data, offsets, model["picked"])
        found = [1 / (1 + np.exp(-np.clip(cells @ model[t], -30, 30))) for t in TARGETS]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *map(pa.array, found)],
            names=[*batch.schema.names, *(f"p_{t}" for t in TARGETS)])


def scored(docs: DataFrame, model: dict[str, np.ndarray], keep_text: bool) -> DataFrame:
    """``row`` (the document's columns), host, path, and both scores of the models."""
    rows = docs.select(
        other_columns(docs, "text"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("path"),
        F.col("text").cast("string").alias("text"))
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(
        "p_low double, p_toxic double").fields])
    found = mapped(rows, score_rows, schema, model=model)
    return found if keep_text else found.drop("text")


def _strength(rates: DataFrame, mean: float) -> float:
    """Documents' worth of the prior that the spread of the sites' rates supports."""
    found = rates.agg(F.var_pop("rate").alias("spread"), F.avg(1 / F.col("n")).alias("inverse"),
                      F.count("*").alias("sites")).first()
    if not found["sites"] or found["sites"] < 2:
        return 1.0
    noise = mean * (1 - mean)
    spread = max(found["spread"] - noise * found["inverse"], 1e-9)
    return float(min(max(noise / spread - 1, 1.0), 1e6))


@dataclass(frozen=True)
class Sites:
    """Sums per host and path, and what their rates are shrunk toward and how much."""

    sums: DataFrame
    means: dict[str, float]
    strength: dict[tuple[str, str], float]

    def rate(self, level: str, target: str, own: Column | None = None) -> Column:
        """A site's rate of a target, shrunk toward the rate one level up.

        With ``own``, a document's score, without that document's part, so that its evidence
        does not count twice.
        """
        prior = F.lit(self.means[target]) if level == "host" else self.rate("host", target, own)
        hits, n = F.col(f"{level}_{target}"), F.col(f"{level}_n")
        if own is not None:
            hits, n = F.greatest(hits - own, F.lit(0.0)), n - 1
        weight = F.lit(self.strength[level, target])
        return (hits + prior * weight) / (n + weight)


def site_rates(scores: DataFrame) -> Sites:
    """What the scores of all documents tell of their hosts and paths."""
    paths = stored(scores.groupBy("host", "path").agg(
        F.count("*").alias("n"), *[F.sum(f"p_{t}").alias(t) for t in TARGETS]), "paths")
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS])
    all_ = paths.agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]).first()
    means = {t: min(max((all_[t] or 0) / (all_["n"] or 1), 1e-6), 1 - 1e-6) for t in TARGETS}
    strength = {}
    for t in TARGETS:
        for level, rows in (("host", hosts), ("path", paths)):
            strength[level, t] = _strength(
                rows.select((F.col(t) / F.col("n")).alias("rate"), "n"), means[t])
    sums = paths.select("host", "path", *(F.col(c).alias(f"path_{c}") for c in ("n", *TARGETS))).join(
        hosts.select("host", *(F.col(c).alias(f"host_{c}") for c in ("n", *TARGETS))), "host")
    return Sites(stored(sums, "rates"), means, strength)


def judged(docs: DataFrame, labels: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: ``row``, the text if asked for, rates, posteriors and ``keep``.

    Rates are those of a document's site without the document itself. Null texts are empty, and
    a null source or lang is a site of its own. Without labels of both kinds nothing is rejected
    for that target. Repeated rows are judged alike. An empty table gives no rows.
    """
    scores = stored(scored(docs, fit(docs, labels), keep_text), "scores")
    sites = site_rates(scores)
    out = scores.join(sites.sums, ["host", "path"])
    rates = {f"{level}_{t}": sites.rate(level, t, F.col(f"p_{t}"))
             for t in TARGETS for level in ("host", "path")}
    out = out.select(*scores.columns, *(r.alias(c) for c, r in rates.items()))
    for t in TARGETS:
        odds = F.lit(1.0)
        for rate, over in ((F.col(f"p_{t}"), False), (F.col(f"path_{t}"), False),
                           (F.lit(sites.means[t]), True)):
            rate = F.least(F.greatest(rate, F.lit(1e-9)), F.lit(1 - 1e-9))
            part = rate / (1 - rate)
            odds = odds / part if over else odds * part
        out = out.withColumn(t, odds / (1 + odds))
    return out.withColumn("keep", (F.col("low") < 0.5) & (F.col("toxic") < 0.5))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    names = [c for c in docs.columns if c != "text"]
    kept = judged(docs, labels, keep_text=True).where("keep")
    columns = {**{c: F.col("row")[c] for c in names}, "text": F.col("text")}
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.col("host").alias("source"),
        F.col("path").alias("lang"), "p_low", "p_toxic", "host_low", "host_toxic", "path_low",
        "path_toxic", F.col("low").alias("low_quality"), "toxic", "keep")
