"""LM scoring: masked pseudo-likelihood of a bidirectional window network.

1. The words of all documents are counted. For the ``VOCABULARY`` most frequent ones the words
   around them are added up, each as a random vector of signs; k-means on these sums parts the
   vocabulary into ``CLUSTERS`` of words that stand in like company (such as those of a language),
   and each cluster into ``BANDS`` of about equal mass by frequency: the closed classes. All other
   words fall into open classes, by the cluster that the vocabulary's words with their last
   letters mostly have. P(word | class) is the word's share of its class, or one of the class's
   words for an open class, whose distinct words are counted too.
2. A network predicts the class of every word from the classes of the two words on either
   side: a vector for each class and side, summed, tanh, and a softmax over the classes. It is
   trained in numpy on all documents, in ``ROUNDS`` shares of them: in a round every task
   starts from the same weights and learns its part of the share; the weights are then
   averaged by the number of words learned. Each document is learned once.
3. A word's conditional log-probability is log P(class | both sides) + log P(word | class); a
   document's score is the sum over its words.

Weights and vocabulary are of fixed size and go to all tasks; what is counted grows with the
corpus and stays in tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LOWER, id_key, mapped, mix, other_columns, parts, stored, table, with_row, word_hashes, words,
)

VOCABULARY = 1 << 16

#: Rarer words are never in the vocabulary, so that words not seen at all have their like.
LEAST_COUNT = 3
CLUSTERS, BANDS = 12, 4
CLOSED = CLUSTERS * BANDS
#: One open class for each cluster, and some for words whose last letters are new.
OPEN = CLUSTERS + 4
CLASSES = CLOSED + OPEN
HIDDEN = 16
SIDE = 2
ROUNDS = 3
RATES = (1.0, 0.5, 0.2)
BATCH = 2048

#: Signs that stand for a word among another's neighbours.
SIGNS = 32

#: Endings of words are told apart by so many values.
TAILS = 1 << 16

#: Words counted at once in a task.
_COUNTED = 1 << 21


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, ending and text of every word."""
    low = LOWER[data]
    starts, ends, owner = words(low, offsets)
    tails = np.zeros(len(starts), np.uint64)
    for back in (1, 2, 3):
        tails = tails * np.uint64(256) + low[np.maximum(ends - back, starts)]
    tails = (mix(tails) & np.uint64(TAILS - 1)).astype(np.int64)
    return word_hashes(low, starts, ends), tails, owner


def count_rows(batches):
    held, size = [], 0

    def counted():
        hashes, tails = (np.concatenate(x) for x in zip(*held, strict=True))
        found, first, many = np.unique(hashes, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(tails[first].astype(np.int32)),
             pa.array(many.astype(np.int64))], names=["word", "tail", "n"])

    for _, data, offsets in parts(batches):
        hashes, tails, _ = _words(data, offsets)
        held.append((hashes, tails))
        size += len(hashes)
        if size >= _COUNTED:
            yield counted()
            held, size = [], 0
    if size:
        yield counted()


class Places:
    """Where words are in a sorted vocabulary; -1 for those that are not.

    Hashes are even, so their first bits lead to one or two candidates.
    """

    def __init__(self, vocabulary: np.ndarray):
        self.vocabulary = vocabulary
        bits = max(int(4 * len(vocabulary)).bit_length(), 1)
        self.shift = np.uint64(64 - bits)
        held = np.bincount((vocabulary >> self.shift).astype(np.int64), minlength=1 << bits)
        self.most = int(held.max(initial=0))
        self.first = (np.cumsum(held) - held).astype(np.int32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.vocabulary):
            return out
        at = self.first[(hashes >> self.shift).astype(np.int64)].astype(np.int64)
        left = np.arange(len(hashes))
        for _ in range(self.most):
            here = at[left]
            inside = here < len(self.vocabulary)
            left, here = left[inside], here[inside]
            word = self.vocabulary[here]
            equal = word == hashes[left]
            out[left[equal]] = here[equal]
            left = left[word < hashes[left]]
            at[left] += 1
        return out


_SIGN_NAMES = [f"s{i}" for i in range(SIGNS)]


def company_rows(batches, vocabulary):
    """For each word of the vocabulary the sum of its neighbours' signs, over the task's texts."""
    total, find = np.zeros((len(vocabulary), SIGNS), np.int64), Places(vocabulary)
    for _, data, offsets in parts(batches):
        hashes, _, owner = _words(data, offsets)
        bits = mix(hashes ^ np.uint64(0x94D049BB133111EB)).view(np.uint8).reshape(-1, 8)
        signs = np.unpackbits(np.ascontiguousarray(bits[:, : SIGNS // 8]), axis=1).view(np.int8) * 2 - 1
        near = np.zeros((len(hashes), SIGNS), np.int8)
        for step in range(1, SIDE + 1):
            same = (owner[:-step] == owner[step:]).view(np.int8)[:, None]
            near[:-step] += signs[step:] * same
            near[step:] += signs[:-step] * same
        places = find.of(hashes)
        order = np.argsort(places, kind="stable")[int((places < 0).sum()) :]
        if len(order):
            places = places[order]
            first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
            total[places[first]] += np.add.reduceat(near[order], first, axis=0, dtype=np.int32)
    seen = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen.astype(np.int32)), *(pa.array(c) for c in total[seen].T)],
        names=["at", *_SIGN_NAMES])


def clusters_of(company: np.ndarray, counts: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """k-means on the directions of the words' company, seen from that of all words."""
    if not len(company):
        return np.zeros(0, np.int64)
    mean = company.sum(axis=0) / max(counts.sum(), 1)
    points = company / np.maximum(counts, 1)[:, None] - mean
    points /= np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-9)
    # Frequent words, of which most is known, give the first centres: each far from the others.
    best = points[np.argsort(-counts, kind="stable")[:1024]]
    centres = [best[0]]
    while len(centres) < clusters:
        near = np.max(best @ np.array(centres).T, axis=1)
        centres.append(best[np.argmin(near)])
    centres = np.array(centres)
    weight = np.sqrt(counts)[:, None]
    for _ in range(25):
        own = np.argmax(points @ centres.T, axis=1)
        for c in range(clusters):
            total = (points * weight)[own == c].sum(axis=0)
            if (own == c).any():
                centres[c] = total / max(np.linalg.norm(total), 1e-9)
    return np.argmax(points @ centres.T, axis=1)


class Lexicon:
    """Classes of words, and the logarithm of a word's share of its class."""

    def __init__(
        self, hashes: np.ndarray, counts: np.ndarray, tails: np.ndarray, company: np.ndarray,
        other_tails: np.ndarray,
    ):
        """The vocabulary, sorted by hash; how many other words each ending has."""
        self.hashes, self.places = hashes, None
        own = clusters_of(company, counts)
        order = np.lexsort((hashes, -counts, own))
        mass = np.cumsum(counts[order]) - counts[order] / 2
        size = np.bincount(own, counts, CLUSTERS)
        began = (np.cumsum(size) - size)[own[order]]
        band = (mass - began) * BANDS // np.maximum(size[own[order]], 1)
        classes = np.zeros(len(hashes), np.int64)
        classes[order] = own[order] * BANDS + np.clip(band, 0, BANDS - 1).astype(np.int64)
        total = np.bincount(classes, counts, CLOSED)
        self.classes = classes.astype(np.uint8)
        self.share = np.log(counts / np.maximum(total[classes], 1)).astype(np.float32)
        # Of each ending the cluster that most of its words have.
        votes = np.bincount(tails * CLUSTERS + own, minlength=TAILS * CLUSTERS).reshape(TAILS, -1)
        self.by_tail = np.where(votes.any(axis=1), votes.argmax(axis=1), CLUSTERS).astype(np.uint8)
        types = np.zeros(OPEN)
        np.add.at(types, self.by_tail, other_tails)
        types[CLUSTERS:] = types[CLUSTERS] / (OPEN - CLUSTERS)
        self.open_share = -np.log(np.maximum(types, 1)).astype(np.float32)

    def of(self, hashes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket = self.by_tail[tails].astype(np.int64)
        new = bucket == CLUSTERS
        bucket[new] += (hashes[new] % np.uint64(OPEN - CLUSTERS)).astype(np.int64)
        classes, share = (CLOSED + bucket).astype(np.uint8), self.open_share[bucket]
        if self.places is None:  # made where it is used
            self.places = Places(self.hashes)
        at = self.places.of(hashes)
        known = at >= 0
        classes[known], share[known] = self.classes[at[known]], self.share[at[known]]
        return classes, share


def sides(classes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The classes of the neighbours of every word; ``CLASSES`` beyond the text."""
    out = np.full((2 * SIDE, len(classes)), CLASSES, np.uint8)
    for row, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        here, there = (slice(-step, None), slice(None, step)) if step < 0 else (
            slice(None, -step), slice(step, None))
        same = owner[here] == owner[there]
        out[row, here][same] = classes[there][same]
    return out


class Network:
    """Vectors of the classes on each side, and the weights of the softmax, in one array."""

    SHAPES = ((2 * SIDE, CLASSES + 1, HIDDEN), (HIDDEN, CLASSES), (1, CLASSES))

    def __init__(self, weights: np.ndarray | None = None):
        sizes = [int(np.prod(s)) for s in self.SHAPES]
        if weights is None:
            weights = np.random.default_rng(7).normal(0, 0.1, sum(sizes))
        self.weights = weights.astype(np.float32)
        cuts = np.split(self.weights, np.cumsum(sizes)[:-1])
        self.vectors, self.out, self.bias = (
            c.reshape(s) for c, s in zip(cuts, self.SHAPES, strict=True))

    def hidden(self, near: np.ndarray) -> np.ndarray:
        total = self.vectors[0][near[0]]
        for side in range(1, 2 * SIDE):
            total = total + self.vectors[side][near[side]]
        return np.tanh(total)

    def chances(self, hidden: np.ndarray) -> np.ndarray:
        raw = hidden @ self.out + self.bias
        raw -= raw.max(axis=1, keepdims=True)
        np.exp(raw, out=raw)
        raw /= raw.sum(axis=1, keepdims=True)
        return raw

    def learn(self, near: np.ndarray, target: np.ndarray, rate: float) -> None:
        count = len(target)
        hidden = self.hidden(near)
        error = self.chances(hidden)
        error[np.arange(count), target] -= 1
        error *= rate / count
        back = (error @ self.out.T) * (1 - hidden * hidden)
        self.out -= hidden.T @ error
        self.bias -= error.sum(axis=0)
        eye = np.eye(CLASSES + 1, dtype=np.float32)
        for side in range(2 * SIDE):
            self.vectors[side] -= eye[near[side]].T @ back

    def log_chances(self, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.zeros(len(target), np.float32)
        for at in range(0, len(target), 1 << 14):
            s = slice(at, at + (1 << 14))
            chances = self.chances(self.hidden(near[:, s]))
            out[s] = np.log(np.maximum(chances[np.arange(len(chances)), target[s]], 1e-30))
        return out


def learned_rows(batches, lexicon, weights, rate):
    """The weights after learning all batches of the task, times the words learned."""
    network, learned = Network(weights.copy()), 0
    for _, data, offsets in parts(batches):
        hashes, tails, owner = _words(data, offsets)
        classes, _ = lexicon.of(hashes, tails)
        near = sides(classes, owner)
        order = np.random.default_rng(len(hashes)).permutation(len(hashes))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            network.learn(near[:, own], classes[own], rate * min(1, len(own) / BATCH))
        learned += len(hashes)
    if learned:
        count = len(network.weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(count, dtype=np.int32)),
             pa.array(network.weights.astype(np.float64) * learned),
             pa.array(np.full(count, learned, np.int64))], names=["at", "sum", "n"])


def score_rows(batches, lexicon, weights):
    network = Network(weights)
    for batch, data, offsets in parts(batches):
        hashes, tails, owner = _words(data, offsets)
        classes, share = lexicon.of(hashes, tails)
        score = network.log_chances(sides(classes, owner), classes).astype(np.float64) + share
        count = np.bincount(owner, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(count.astype(np.int64)),
             # Sums over no words at all would be whole numbers.
             pa.array(np.bincount(owner, score, batch.num_rows).astype(np.float64))],
            names=["row", "n_words", "log_likelihood"])


def fit(docs: DataFrame, rounds: int = ROUNDS) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and the trained weights."""
    texts = docs.select(id_key().alias("k"), F.col("text").cast("string").alias("text"))
    counts = stored(mapped(texts.select("text"), count_rows, "word long, tail int, n long")
                    .groupBy("word").agg(F.sum("n").alias("n"), F.min("tail").alias("tail")), "counts")
    best = counts.where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "word").limit(VOCABULARY)
    best = stored(best, "vocabulary")
    top = best.toArrow()
    order = np.argsort(top["word"].to_numpy().view(np.uint64))
    hashes = top["word"].to_numpy().view(np.uint64)[order]
    others = np.zeros(TAILS)
    for row in counts.join(best.select("word"), "word", "left_anti").groupBy("tail").count().collect():
        others[row["tail"]] = row["count"]
    sums = mapped(
        texts.select("text"), company_rows, ", ".join(["at int", *(f"{c} long" for c in _SIGN_NAMES)]),
        vocabulary=hashes).groupBy("at").agg(*(F.sum(c).alias(c) for c in _SIGN_NAMES)).toArrow()
    company = np.zeros((len(hashes), SIGNS))
    company[sums["at"].to_numpy()] = np.stack([sums[c].to_numpy() for c in _SIGN_NAMES], axis=1)
    lexicon = Lexicon(
        hashes, top["n"].to_numpy().astype(np.float64)[order],
        top["tail"].to_numpy().astype(np.int64)[order], company, others)
    weights = Network().weights
    share = F.pmod(F.xxhash64("k"), F.lit(rounds))
    for turn in range(rounds):
        found = mapped(
            texts.where(share == turn).select("text"), learned_rows,
            "at int, sum double, n long", lexicon=lexicon, weights=weights,
            rate=RATES[min(turn, len(RATES) - 1)],
        ).groupBy("at").agg((F.sum("sum") / F.sum("n")).alias("weight")).collect()
        if found:
            weights = np.array(
                [r["weight"] for r in sorted(found, key=lambda r: r["at"])], np.float32)
    return lexicon, weights


def log_likelihoods(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray) -> DataFrame:
    """One row per document: ``row`` (its columns but the text), n_words, log_likelihood.

    A text without words (null or empty too) has 0 of both. Repeated rows score alike. An
    empty table gives no rows, and the model fitted on it gives every class one chance.
    """
    rows = docs.select(
        other_columns(docs, "text"),
        F.col("text").cast("string").alias("text"))
    return mapped(rows, score_rows, with_row(rows, "n_words long, log_likelihood double"),
                  lexicon=lexicon, weights=weights)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon, weights = fit(docs)
    return log_likelihoods(docs, lexicon, weights).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "log_likelihood",
        F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
        .alias("mean_log_likelihood"))
