"""Language ID against plain naive Bayes over the same grams, and held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_id
from tidemark.llm.common import mix

LANGS = "doc_id long, text string, lang string, `a.b` string, row int, best string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, x, "dot", 1, "b") for i, t, x in rows], LANGS)


def letters(text: str) -> str:
    out = " "
    for c in text:
        c = c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " "
        if c != " " or out[-1] != " ":
            out += c
    return out


def grams(text, longest, buckets):
    import numpy as np

    text, out = letters(text), Counter()
    for length in range(1, longest + 1):
        for at in range(len(text) - length + 1):
            part = text[at : at + length]
            if part == " ":
                continue
            value = np.zeros(1, np.uint64)
            for n, c in enumerate(part):
                value = mix(value * np.uint64(31) + np.uint64(ord(c)) + np.uint64(n + 1))
            out[int(value[0]) % buckets] += 1
    return out


def brute(train, texts, longest, buckets):
    counts, n_docs = {}, Counter()
    for text, lang in train:
        if any(c.isalpha() for c in text or ""):
            counts.setdefault(lang, Counter()).update(grams(text, longest, buckets))
            n_docs[lang] += 1
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or "") or not counts:
            out.append(("und", 0.0))
            continue
        found = {}
        for lang in sorted(counts):
            total = sum(counts[lang].values()) + language_id.SMOOTHING * buckets
            found[lang] = math.log(n_docs[lang] / sum(n_docs.values())) + sum(
                n * math.log((counts[lang][b] + language_id.SMOOTHING) / total)
                for b, n in grams(text, longest, buckets).items())
        best = max(found, key=lambda x: found[x])
        out.append((best, 1 / sum(math.exp(v - found[best]) for v in found.values())))
    return out


def made(seed, n_langs=3, n=60):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.randrange(n_langs)
        alphabet = ["abcdeé", "cdefgÄß", "efghiжш字"][lang % 3] + "xyz"[lang // 3 % 3]
        text = "".join(draw.choice(alphabet + " .,1") for _ in range(draw.randint(0, 40)))
        rows.append((i, draw.choice([text, text, text.upper()]), f"l{lang}"))
    return rows + [(900, None, "l0"), (901, "", "l1"), (902, "12 .!", "l1"), (903, "ab", None),
                   (None, "cd ef", "l2"), (903, "ab", None)]


@pytest.mark.parametrize("block, stride", [(64, 1 << 19), (2, 1 << 19), (64, 50)])
def test_scores_equal_plain_naive_bayes(spark, monkeypatch, block, stride):
    monkeypatch.setattr(language_id, "BLOCK", block)
    rows = made(4, n_langs=5)
    docs = documents(spark, rows)
    # Fewer places a piece: run the row functions here, where the setting holds.
    monkeypatch.setattr(language_id, "STRIDE", stride)
    model = language_id.learn(docs, longest=3, buckets=256)
    found = language_id.identify(docs, model).select(
        "row.*", "lang_pred", "score").collect()
    want = brute([(t, x) for _, t, x in rows if x is not None], [t for _, t, _ in rows], 3, 256)
    expected = Counter((i, x, w[0]) for (i, _, x), w in zip(rows, want, strict=True))
    assert Counter((r["doc_id"], r["lang"], r["lang_pred"]) for r in found) == expected
    scores = {(i, x): w[1] for (i, _, x), w in zip(rows, want, strict=True)}
    for r in found:
        assert r["score"] == pytest.approx(scores[r["doc_id"], r["lang"]], abs=1e-9)
        assert r["a.b"] == "dot" and r["best"] == "b"


def test_pieces_of_long_texts_add_up(monkeypatch):
    import numpy as np

    draw = random.Random(5)
    text = ("." + "".join(draw.choice("ab é.字") for _ in range(3000)) + ".").encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 0, len(text), len(text)])
    chars, starts = language_id.characters(data, offsets)
    assert "".join(map(chr, chars)) == " " + letters(text.decode()) + " "

    def counted():
        return Counter(
            (int(b), int(o)) for bs, os in language_id.gram_rows(chars, starts, 4, 64)
            for b, o in zip(bs, os, strict=True))

    whole = counted()
    monkeypatch.setattr(language_id, "STRIDE", 37)
    assert counted() == whole
    assert language_id.with_letters(chars, starts).tolist() == [False, True, False]


def test_bytes_that_are_no_text_do_not_stop_it():
    import numpy as np

    data = np.frombuffer(b"ab\xff\xfecd\xc3\xa9", np.uint8)
    chars, starts = language_id.characters(data, np.array([0, 5, 8]))
    assert "".join(map(chr, chars)) == " ab c dé" and starts.tolist() == [0, 5, 8]


def test_nothing_learned_and_empty_tables(spark):
    rows = documents(spark, [(1, "text", None), (2, None, "en")])
    found = language_id.identify(rows, language_id.learn(rows)).select("lang_pred", "score").collect()
    assert [tuple(r) for r in found] == [("und", 0.0)] * 2
    none = documents(spark, [])
    assert language_id.identify(none, language_id.learn(none)).count() == 0
    ties = documents(spark, [(1, "abc", "y"), (2, "abc", "x")])
    found = language_id.identify(ties, language_id.learn(ties)).collect()
    assert {r["lang_pred"] for r in found} == {"x"} and found[0]["lead"] == 0


def test_the_query_holds_out_a_fifth_and_finds_their_languages(spark, sf_dir):
    found = language_id.op11_language_id(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 200
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == r["lang"] for r in found if r["held_out"]]
    assert sum(held) >= 0.95 * len(held) > 10


def test_held_out_rows_teach_nothing(spark, tmp_path):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]
    rows = [(i, "abc abd", "wrong") for i in ids] + [
        (i, "abc abd", "right") for i in range(200) if i not in ids]
    documents(spark, rows).withColumn("source", F.lit("s")).write.parquet(
        f"{tmp_path}/documents.parquet")
    found = language_id.op11_language_id(spark, str(tmp_path)).collect()
    assert {r["lang_pred"] for r in found} == {"right"}
