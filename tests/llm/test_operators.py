"""Each operator against a brute-force version, and on nulls, empty tables and odd rows."""

from __future__ import annotations

import base64
import bz2
import gzip
import hashlib
import itertools
import lzma
import random
import re
import time
import urllib.parse
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (
    chat_format, decontamination, fingerprints, jaccard_join, language_model, line_dedup, packing,
    quality, secret_scan, suffix_dedup,
)
from tidemark.llm.common import utf8

ODD = "doc_id long, text string, lang string, source string, n_chars long, k string, row int"


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def documents(spark, texts, ids=None):
    """Documents with columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(
        [(i, t, "en" if t else None, "s", len(t or ""), "x", 7)
         for i, t in zip(ids, texts, strict=True)], ODD)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)

    def prose(count):
        return " ".join(f"w{draw.randint(0, 4000)}" for _ in range(count))

    common = [prose(30) for _ in range(8)] + ["x" * 300, "ab" * 90, "é" * 80]
    out = [None, "", " \n ", "a", "A", "a b", "a" * 99, "a" * 350, prose(3000)]
    for _ in range(60):
        lines = [draw.choice(common) if draw.random() < 0.4 else prose(draw.choice([3, 25, 60]))
                 for _ in range(draw.randint(1, 5))]
        out.append(draw.choice(["\n", " "]).join(lines))
    for base in out[9:29]:
        words = base.split(" ")
        words[draw.randrange(len(words))] = "changed"
        out += [" ".join(words), base]
    return out


# 1 ---------------------------------------------------------------------------------


def wrapped(secret):
    quoted, coded = urllib.parse.quote(secret), base64.b64encode(secret.encode()).decode()
    return [
        quoted, urllib.parse.quote(quoted), coded, base64.b64encode(coded.encode()).decode(),
        base64.b64encode(gzip.compress(secret.encode())).decode(),
        "".join(f"\\u{ord(c):04x}" for c in secret), "".join(f"&#{ord(c)};" for c in secret),
        "".join(f"%{b:02x}" for b in zlib.compress(secret.encode())),
    ]


def test_secrets_under_layers_map_to_the_run_that_holds_them():
    secret = 'password="hunter2hunter2"'
    for hidden in wrapped(secret):
        base, spans, _, _ = secret_scan.find_secrets(f"é before {hidden} after")
        assert not base
        assert [s[2] for s in spans] == ["assign"]
        assert 9 <= spans[0][0] < spans[0][1] <= 9 + len(hidden)


def test_a_layer_seen_before_ends_the_search():
    assert secret_scan.find_secrets("%2525252541KIA" + "A" * 20)[2] < 10
    large = base64.b64encode(gzip.compress(b"a" * 5000)).decode()
    assert secret_scan.find_secrets(large, most=100)[3] == 1


def test_layers_that_are_no_clean_text_are_scanned():
    secret = b'password="hunter2hunter2"'
    noise = bytes(range(256))
    first, second = b"nothing here ", secret
    lines = base64.encodebytes(b"x" * 50 + secret + b"y" * 90).decode()
    for hidden in (
        base64.b64encode(noise + secret + noise).decode(),
        base64.b64encode("é ü ".encode("latin-1") + secret).decode(),
        base64.b64encode(gzip.compress(noise + secret)).decode(),
        base64.b64encode(gzip.compress(first) + gzip.compress(second)).decode(),
        base64.b64encode(bz2.compress(first) + bz2.compress(second)).decode(),
        base64.b64encode(lzma.compress(first) + lzma.compress(second)).decode(),
        base64.b64encode(zstandard.compress(first) + zstandard.compress(second)).decode(),
        lines, lines.replace("\n", "\r\n"),
        base64.encodebytes(gzip.compress(random.Random(1).randbytes(200) + secret)).decode(),
    ):
        spans = secret_scan.find_secrets(f"é before {hidden} after")[1]
        assert "assign" in [s[2] for s in spans]
        assert all(9 <= s[0] < s[1] <= 9 + len(hidden) for s in spans)


def test_payloads_behind_other_characters_and_bytes_are_found():
    secret = b'password="hunter2hunter2"'
    coded = base64.b64encode(secret).decode()
    squeezed = zlib.compressobj(9, zlib.DEFLATED, 9)
    small_window = squeezed.compress(secret * 3) + squeezed.flush()
    raw = zlib.compressobj(9, zlib.DEFLATED, -15)
    raw_data = raw.compress(secret * 3) + raw.flush()
    escaped = "".join(f"\\u{{{c:x}}}" for c in secret)
    for hidden in (
        f"https://h.com/dl/{coded}", f"a/{coded}", f"id_{coded}", f"Basic{coded}", f"ab{coded}",
        f"x-{coded}", base64.b64encode(b"HEAD" + gzip.compress(secret)).decode(),
        base64.b64encode(b"HEAD" + gzip.compress(secret) + b"TAIL").decode(),
        base64.b64encode(small_window).decode(), base64.b64encode(raw_data).decode(),
        base64.b64encode(b"v1 " + lzma.compress(secret)).decode(),
        base64.b64encode(b"v1 " + bz2.compress(secret)).decode(),
        base64.b64encode(b"v1 " + zstandard.compress(secret)).decode(),
        escaped, "".join(f"\\U{c:08x}" for c in secret),
    ):
        base, spans, _, _ = secret_scan.find_secrets(f"é before {hidden} after")
        assert not base and "assign" in [s[2] for s in spans], hidden
        assert all(9 <= s[0] < s[1] <= 9 + len(hidden) for s in spans)


@pytest.mark.parametrize("pack", [
    gzip.compress, bz2.compress, lzma.compress, zstandard.compress, zlib.compress])
def test_layers_too_large_to_open_at_once_are_read_in_blocks(pack, monkeypatch):
    monkeypatch.setattr(secret_scan, "OVERLAP", 1 << 10)
    draw = random.Random(2)
    filler = "".join(draw.choice("abcdefgh ") for _ in range(50_000))
    # One secret lies across the border of two blocks.
    text = filler[:8180] + ' password="hunter2hunter2" ' + filler + " AKIA" + "B" * 16 + " " + filler[:100]
    hidden = base64.b64encode(b"v1" + pack(text.encode())).decode()
    _, spans, _, closed = secret_scan.find_secrets(f"before {hidden} after", 1 << 13)
    assert {"assign", "access"} <= {s[2] for s in spans} and closed
    assert all(7 <= s[0] < s[1] <= 7 + len(hidden) for s in spans)


def test_long_texts_of_escapes_and_of_words_take_linear_time():
    for piece in ("%41 ", "\\x41 ", "abcdefghijklmnopqrst "):
        start = time.perf_counter()
        secret_scan.find_secrets(piece * (1_000_000 // len(piece)))
        assert time.perf_counter() - start < 20


def test_secret_rows(spark, texts):
    given = [*texts, "AKIA" + "B" * 16, "AKIA" + "B" * 15, "f" * 24, "f" * 23,
             "secret: 'abcdef' token=abc", "x API_KEY = \"a.b/c+d=\""]
    plain = re.compile(secret_scan._ASSIGN.pattern, re.I | re.A)
    for row in secret_scan.scan_secrets(documents(spark, given)).collect():
        text = given[row["row"]["doc_id"]] or ""
        want = [(m.start(), 0, m.end(), "assign") for m in plain.finditer(text) if len(m[2]) > 5]
        want += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text)
                 if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text)
                 if len(m[0]) >= 24]
        assert [(s["kind"], s["start"], s["stop"]) for s in row["base"]] == [
            (k, s, e) for s, _, e, k in sorted(want)]
        assert set(map(tuple, row["base"])) <= set(map(tuple, row["spans"]))


# 2 ---------------------------------------------------------------------------------


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    given = [*texts, "don't <|endoftext|> İ ΣΑΣ é 12ab 日本 'ss", "<|ENDOFTEXT|>"]
    whole = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 1]
           for i, t in enumerate(given)}
    docs = documents(spark, given)
    packed = packing.pack(docs, capacity=512)
    rows = packed.select("row.doc_id", *packed.columns[1:]).toPandas()
    for r in rows.itertuples():
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (len(piece), zlib.crc32(piece.tobytes())) == (r.length, r.ids_crc32)
    assert rows.groupby("doc_id").length.sum().to_dict() == {i: len(x) for i, x in ids.items()}
    ordered = rows.sort_values(["sequence_id", "offset"])
    before = ordered.groupby("sequence_id").length.cumsum() - ordered.length
    assert (before == ordered.offset).all()
    assert ordered.groupby("sequence_id").length.sum().max() <= 512
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 512) + 1
    made = packing.sequences(docs, packed, capacity=512).collect()
    assert sum(len(r["ids"]) for r in made) == rows.length.sum()


def test_fullest_is_the_best_there_is():
    draw = random.Random(1)
    for _ in range(60):
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(5)}
        room = draw.randint(1, 60)
        pieces = [x for x, n in counts.items() for _ in range(n)]
        best = max(s for k in range(len(pieces) + 1) for c in itertools.combinations(pieces, k)
                   if (s := sum(c)) <= room)
        used = packing.fullest(counts, room)
        assert sum(x * n for x, n in used.items()) == best
        assert all(n <= counts[x] for x, n in used.items())


# 3 ---------------------------------------------------------------------------------


def without_repeats(given, window=100):
    seen, out = set(), []
    for text in given:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - window + 1):
            if data[i : i + window] in seen:
                gone[i : i + window] = True
            seen.add(data[i : i + window])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((len(data), int(gone.sum()), spans, kept))
    return out


@pytest.mark.parametrize("crowd", [50_000, 2])
def test_repeats_are_cut(spark, texts, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    found = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
             for r in suffix_dedup.drop_repeats(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == without_repeats(texts)


def test_surroundings_move_once(spark, monkeypatch):
    """Crowded grams are few: they are sent to the surroundings, which go to their gram once."""
    plans, stored = {}, suffix_dedup.stored

    def kept(rows, label, *codec):
        plans[label] = rows._jdf.queryExecution().executedPlan().toString()
        return stored(rows, label, *codec)

    monkeypatch.setattr(suffix_dedup, "stored", kept)
    line = " ".join(f"q{i}" for i in range(60))
    suffix_dedup.drop_repeats(documents(spark, [line + "a", line + "b", "c" + line])).collect()
    assert plans["cuts"].count("Exchange hashpartitioning(gram") == 1
    assert "Exchange hashpartitioning(gram" not in plans["firsts"]


def test_repeated_rows_are_one_document(spark):
    line = " ".join(f"q{i}" for i in range(60))
    rows = suffix_dedup.drop_repeats(
        documents(spark, [line, line, line], [1, 1, None])).collect()
    assert sorted((r["row"]["doc_id"] or 99, r["n_removed"]) for r in rows) == [
        (1, 0), (1, 0), (99, len(line))]


def test_repeated_rows_of_one_part_are_one_document(spark):
    lines = [" ".join(f"{c}{i}" for i in range(60)) for c in "qr"]
    docs = documents(spark, [lines[0], lines[0], lines[0], lines[1], lines[1]],
                     [1, 1, 2, None, None]).coalesce(1)
    rows = suffix_dedup.drop_repeats(docs).collect()
    assert sorted((r["row"]["doc_id"] or 99, r["n_removed"]) for r in rows) == [
        (1, 0), (1, 0), (2, len(lines[0])), (99, 0), (99, 0)]


def test_rows_that_share_an_id_keep_their_own_text(spark):
    """Thousands without an id, so that short hashes of their texts would agree."""
    draw = random.Random(13)
    line = " ".join(f"q{i}" for i in range(40))
    rows = []
    for i in range(4000):
        own = f"unique text number {i} " + "".join(draw.choice("abcdefgh") for _ in range(90))
        rows.append((draw.choice([None, None, 7, 8]), own + (line + str(i) if i % 500 == 3 else "")))
    rows += rows[:20]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, hashes[r[1]]))
    seen, want = False, {}
    for row in distinct:
        want[row] = len(line) if line in row[1] and seen else 0
        seen = seen or line in row[1]
    found = suffix_dedup.drop_repeats(docs).select(
        "row.doc_id", "n_bytes", "n_removed", F.col("kept").cast("string").alias("kept")).collect()
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["kept"]) for r in found)
    cut = [(i, t, want[i, t]) for i, t in rows]
    # The line may take along the equal bytes beside it: the digits that follow agree in part.
    assert len(got) == len(cut) and sum(r[2] > 0 for r in got) == sum(n > 0 for *_, n in cut) >= 7
    whole = sorted((i or 0, t) for i, t, n in cut if not n)
    assert sorted((i, k) for i, _, n, k in got if not n) == whole


def test_tables_that_led_to_the_cuts_are_deleted(spark):
    """What is read last, the texts and their cuts, lies on the disks without them."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.glob("*")}
    line = " ".join(f"q{i}" for i in range(60))
    rows = suffix_dedup.drop_repeats(documents(spark, [line, "x" + line]))
    new = {p.name for p in shared.glob("*")} - before
    assert {name.rpartition("-")[0] for name in new} == {"cuts"}
    assert sorted(r["n_removed"] for r in rows.collect()) == [0, len(line)]


# 4 ---------------------------------------------------------------------------------


def jaccard(given):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for text in given:
        words = [w for w in re.split("[ \t\n\v\f\r]+", (text or "").translate(lower)) if w]
        sets.append(frozenset(
            [tuple(words)] if 0 < len(words) < 3 else zip(words, words[1:], words[2:])))
    first = list(range(len(sets)))

    def root(x):
        while first[x] != x:
            x = first[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 90 * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            first[b] = a
    return [(len(s), root(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("pivots", [2, 0])
def test_components(spark, texts, pivots):
    draw, given = random.Random(8), list(texts)
    for size in (12, 40, 150, 400):  # chains of edits about the threshold
        words = [f"v{draw.randint(0, 9999)}" for _ in range(size)]
        for _ in range(12):
            words = list(words)
            for _ in range(max(1, size // 70)):
                words[draw.randrange(len(words))] = f"v{draw.randint(0, 9999)}"
            given.append(" ".join(words))
    found = {r["k"]: (r["n_shingles"], r["first"]["k"]) for r in
             jaccard_join.jaccard_components(documents(spark, given), pivots=pivots).collect()}
    assert [found[i] for i in range(len(given))] == jaccard(given)


def test_one_document_of_each_component_stays(spark):
    text = " ".join(f"u{i}" for i in range(50))
    docs = documents(spark, [text, text, text, text, None, None, "", "z"],
                     [5, 5, 9, None, 1, 1, 2, 3])
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 2, 3, 5]


def first_of_five_word_component(given):
    """Brute force of links at a similarity of 0.8, component by component."""
    sets = []
    for text in given:
        words = re.split("[ \t\n\v\f\r]+", (text or "").lower().strip(" \t\n\v\f\r"))
        runs = {" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}
        sets.append(runs - {""})
    first = {}
    for i in range(len(sets)):
        if i in first:
            continue
        first[i], work = i, [i]
        while work:
            a = work.pop()
            for b in range(len(sets)):
                both = len(sets[a] & sets[b])
                if b not in first and both and 10 * both >= 8 * len(sets[a] | sets[b]):
                    first[b] = i
                    work.append(b)
    return first


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_region_that_neither_spares(percent):
    """Over many sets that share hot passages, whose regions are crowded."""
    draw = np.random.default_rng(percent)
    classes = jaccard_join.SizeClasses(percent)
    hot = [draw.integers(0, 2**63, 60, dtype=np.uint64) for _ in range(3)]
    sets = []
    for _ in range(120):
        n = int(draw.choice([6, 20, 60, 200, 700]))
        base = np.concatenate([draw.integers(0, 2**63, n, dtype=np.uint64), *hot[: draw.integers(4)]])
        sets.append(np.unique(base))
        for share in draw.uniform(0, (100 - percent) / 100, 2):
            copy = base.copy()
            gone = draw.choice(len(base), int(len(base) * share / 2) + 1, replace=False)
            copy[gone] = draw.integers(0, 2**63, len(gone), dtype=np.uint64)
            sets.append(np.unique(copy[int(draw.integers(0, 3)) :]))
    found, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    key, owner, spare = jaccard_join.regions(found, of, len(sets), classes)
    crowd = {}
    for k, o in set(zip(key.tolist(), owner.tolist())):
        crowd[k] = crowd.get(k, 0) + 1
    own = {}
    for k, o, s in set(zip(key.tolist(), owner.tolist(), spare.tolist())):
        own.setdefault((o, s >> 8, s & 255), []).append((crowd[k], k))
    kept = [set() for _ in sets]
    for (o, _, n), regions in own.items():
        kept[o] |= {k for _, k in sorted(regions, reverse=True)[n:]}
    linked = 0
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and not np.array_equal(
                sets[i], sets[j]):
            linked += 1
            assert kept[i] & kept[j], (len(sets[i]), len(sets[j]), both)
    assert linked > 60


def test_wide_sketches_never_rule_out_a_link(spark):
    draw = np.random.default_rng(4)
    ruled_out = 0
    for percent in (80, 90):
        for _ in range(150):
            n = int(draw.integers(257, 3000))
            every = draw.integers(0, 2**63, 3 * n, dtype=np.uint64)
            one = np.unique(every[:n])
            share = draw.choice([0, 0.5, 0.75, 0.8, 0.85, 0.9, 0.95, 1])
            most = draw.integers(n // 2, 2 * n)
            other = np.unique(np.concatenate([every[: int(n * share)], every[n : n + most]])[
                : int(draw.integers(257, 2 * n))])
            sets = one, other
            sketch = [jaccard_join.wide_sketches(x, np.zeros(len(x), np.int64), 1)[0] for x in sets]
            if None in sketch:
                continue
            apart = jaccard_join.bits_apart(*sketch)
            assert apart == jaccard_join.bits_apart(*sketch[::-1])
            both = len(np.intersect1d(one, other))
            assert apart <= len(one) + len(other) - 2 * both
            union = len(one) + len(other) - both
            gone = apart * (100 + percent) > (len(one) + len(other)) * (100 - percent)
            assert not (gone and 100 * both >= percent * union)
            if 10 * both < union:
                ruled_out += gone
                assert gone
    assert ruled_out > 20


def test_the_stage_joins_five_words_at_eight_tenths(spark, texts):
    draw, given = random.Random(9), list(texts)
    for size in (20, 60, 200, 1000):
        words = [f"v{draw.randint(0, 9999)}" for _ in range(size)]
        given.append(" ".join(words))
        for share in (0.01, 0.02, 0.03, 0.05):  # scattered words changed
            copy = list(words)
            for at in draw.sample(range(size), max(1, int(size * share))):
                copy[at] = "changed"
            given.append(" ".join(copy))
        for share in (0.1, 0.2, 0.24, 0.3):  # a footer
            given.append(" ".join(words + [f"f{share}-{i}" for i in range(int(size * share))]))
    kept = corpus_pipeline.near_duplicates(spark, documents(spark, given), "")
    want = [i for i, first in sorted(first_of_five_word_component(given).items()) if first == i]
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    # The rule of three words and nine tenths keeps other documents here.
    assert want != [i for i, (_, first) in enumerate(jaccard(given)) if first == i]


# 5 ---------------------------------------------------------------------------------


def test_leaks(spark):
    draw = random.Random(4)

    def prose(count):
        return [f"w{draw.randint(0, 300)}" for _ in range(count)]

    items = [prose(n) for n in (40, 15, 60)]
    edited = [w if i % 7 else "other" for i, w in enumerate(items[0])]
    del edited[20]
    given = [
        " ".join(prose(50) + items[0] + prose(50)), " ".join(prose(9) + edited + prose(9)),
        " ".join(items[1]).upper(), ", ".join(items[2]), " ".join(prose(400)), None, "",
        " ".join(items[0][:8] + prose(60)),
    ]
    tests = spark.createDataFrame(
        [*((i, " ".join(t)) for i, t in enumerate(items)), (7, None), (None, "w1 w2")],
        "item_id long, text string")
    docs = documents(spark, given)
    pairs = decontamination.find_leaks(docs, tests).select("row.doc_id", "item_id").collect()
    assert sorted(map(tuple, pairs)) == [(0, 0), (1, 0), (2, 1), (3, 2)]
    clean = decontamination.without_leaks(docs, tests)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == [4, 5, 6, 7]
    assert decontamination.find_leaks(docs, tests.limit(0)).isEmpty()


@pytest.mark.parametrize("edit", ["changed", "put in"])
def test_a_lone_edited_copy_is_a_leak(spark, edit):
    """No other document has any of the item's runs, and few of them are left."""
    words = [f"i{n}" for n in range(60)]
    if edit == "changed":
        copy = [w if n % 5 else f"other{n}" for n, w in enumerate(words)]
    else:  # nearly as many words as the item has, by threes
        copy = [x for n, w in enumerate(words)
                for x in ([w] if n % 3 else [f"a{n}", f"b{n}", f"c{n}", w])]
    around = [f"x{n}" for n in range(300)]
    docs = documents(spark, [" ".join(around[:150] + copy + around[150:]), " ".join(around)])
    tests = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    row, = decontamination.find_leaks(docs, tests).collect()
    points = 48 * 2 - 11 if edit == "changed" else 60 * 2 - 19 * 3
    assert (row["row"]["doc_id"], row["score"]) == (0, points / 120)
    assert [r["doc_id"] for r in decontamination.without_leaks(docs, tests).collect()] == [1]


def test_alignment_points():
    def slow(a, b):
        cells = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(len(a)), range(len(b))):
            cells[i + 1, j + 1] = max(0, cells[i, j] + (2 if a[i] == b[j] else -1),
                                      cells[i, j + 1] - 1, cells[i + 1, j] - 1)
        return cells.max()

    draw = np.random.default_rng(0)
    for _ in range(20):
        a, b = draw.integers(2, 6, 12), draw.integers(2, 6, 20)
        got = decontamination.aligned(a[None].astype(np.uint64), b[None].astype(np.uint64))[0]
        assert got == slow(a, b)


# 6 ---------------------------------------------------------------------------------


def test_the_model_beats_word_counts_on_held_out_text(spark):
    """Against a unigram model of the same classes and shares, by nats a word."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lexicon, weights = language_model.fit(docs.where("doc_id % 5 <> 0"))

    def classes(rows):
        data, offsets = utf8(rows.select("text").toArrow()["text"])
        hashes, tails, _ = language_model._words(data, offsets)
        return lexicon.of(hashes, tails)

    found, _ = classes(docs.where("doc_id % 5 <> 0"))
    mass = np.log((np.bincount(found, minlength=language_model.CLASSES) + 0.5) / len(found))
    held, share = classes(docs.where("doc_id % 5 = 0"))
    counted = float((mass[held] + share).mean())
    network = language_model.log_likelihoods(docs.where("doc_id % 5 = 0"), lexicon, weights).agg(
        F.sum("log_likelihood") / F.sum("n_words")).first()[0]
    assert network > counted + 0.3


def test_words_of_like_company_share_a_cluster():
    draw = np.random.default_rng(3)
    texts = []
    for _ in range(400):
        letter = "ab"[draw.integers(2)]
        texts.append(" ".join(f"{letter}{draw.integers(40)}" for _ in range(30)).encode())
    data = np.frombuffer(b" ".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    offsets[-1] -= 1
    hashes, _, _ = language_model._words(data, offsets)
    vocabulary, counts = np.unique(hashes, return_counts=True)
    batch = pa.RecordBatch.from_arrays([pa.array([t.decode() for t in texts])], names=["text"])
    (rows,) = language_model.company_rows([batch], vocabulary)
    company = np.zeros((len(vocabulary), language_model.SIGNS))
    company[rows["at"].to_numpy()] = np.stack([rows[f"s{i}"].to_numpy() for i in range(language_model.SIGNS)], 1)
    own = language_model.clusters_of(company, counts.astype(float), 2)
    names = {}
    for word in {w for t in texts for w in t.split()}:
        h = language_model._words(np.frombuffer(word, np.uint8), np.array([0, len(word)]))[0][0]
        names.setdefault(word[:1], set()).add(int(own[np.searchsorted(vocabulary, h)]))
    assert sorted(map(len, names.values())) == [1, 1] and names[b"a"] != names[b"b"]


def test_texts_without_words_score_nothing(spark):
    docs = documents(spark, [None, "", " \n", "a b c a b", "a b c a b"]).repartition(5, "doc_id")
    model = language_model.fit(docs)
    rows = language_model.log_likelihoods(docs, *model).select("row.doc_id", "n_words", "log_likelihood")
    found = {r["doc_id"]: tuple(r)[1:] for r in rows.collect()}
    assert [found[i] for i in range(3)] == [(0, 0.0)] * 3
    assert found[3] == found[4] and found[3][0] == 5 and found[3][1] < 0
    empty = docs.where("doc_id < 3")
    assert {tuple(r)[1:] for r in language_model.log_likelihoods(empty, *model).select(
        "row.doc_id", "n_words", "log_likelihood").collect()} == {(0, 0.0)}


def test_words_are_found_in_a_sorted_vocabulary():
    draw = np.random.default_rng(2)
    for size in (0, 1, 2, 50, 5000):
        words = np.unique(draw.integers(0, 2**64, size, dtype=np.uint64))
        words[: size // 3] = words[: size // 3] >> np.uint64(40)  # many with equal first bits
        words = np.unique(words)
        asked = np.concatenate([words, words + np.uint64(1), draw.integers(0, 2**64, 99, dtype=np.uint64)])
        places = {int(w): i for i, w in enumerate(words)}
        assert language_model.Places(words).of(asked).tolist() == [places.get(int(w), -1) for w in asked]


def test_chances_of_a_word_sum_to_one():
    draw = np.random.default_rng(6)
    count = 300
    hashes = np.sort(draw.integers(0, 2**63, count, dtype=np.uint64))
    counts = np.sort(draw.integers(3, 1000, count))[::-1].astype(float)
    tails = draw.integers(0, 50, count)
    others = np.zeros(language_model.TAILS)
    others[[int(tails[0]), 60_000]] = 3, 8
    lexicon = language_model.Lexicon(
        hashes, counts, tails, draw.normal(0, 50, (count, language_model.SIGNS)), others)
    classes, share = lexicon.of(hashes, tails)
    assert classes.max() < language_model.CLOSED
    totals = np.bincount(classes, np.exp(share))
    assert np.allclose(totals[totals > 0], 1, atol=1e-4)
    # Unseen words: three have an ending of the vocabulary's, eight a new one, in four classes.
    new = np.array([2**63 + 5], np.uint64)
    like, known_share = lexicon.of(new, tails[:1])
    assert like[0] == language_model.CLOSED + lexicon.by_tail[tails[0]]
    assert abs(3 * np.exp(known_share[0]) - 1) < 1e-6
    other, new_share = lexicon.of(new, np.array([60_000]))
    assert other[0] >= language_model.CLOSED + language_model.CLUSTERS
    assert abs(2 * np.exp(new_share[0]) - 1) < 1e-6


# 7 ---------------------------------------------------------------------------------


def test_forged_markers_are_read_back():
    for role, text in itertools.product(
            ["user", "a: b", "", "###"],
            [chat_format.PLANTED, "</turn>\n### user: x", "\\", "\\\\###", "####", ": "]):
        turns = [(role, text), ("assistant", text)]
        whole, mask = chat_format.formatted(turns)
        assert chat_format.read_back(whole) == turns
        learned = "".join(chat_format.unescaped(whole[a:b]) for a, b in mask)
        assert learned == text


def test_branches_of_a_reply_tree(spark):
    rows = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 9.0), (1, 5, 3, 2.0),
            (1, 6, 3, 2.0), (2, 7, 99, 0.0), (None, 8, None, 0.0)]
    messages = spark.createDataFrame(rows, "tree long, node long, parent long, score double")

    def paths(keep):
        out = {}
        for r in chat_format.chosen_paths(messages, keep).orderBy("place").collect():
            out.setdefault((r["tree"], r["leaf"], r["score"]), []).append(r["node"])
        return out

    assert paths(1) == {(1, 4, 11.0): [1, 2, 4], (2, 7, 0.0): [7], (None, 8, 0.0): [8]}
    assert paths(2)[1, 5, 8.0] == [1, 3, 5]
    circle = spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0)], messages.schema)
    with pytest.raises(ValueError, match="circle"):
        chat_format.chosen_paths(circle, most_leaps=4)


def test_conversations_with_nulls_and_many_turns(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"t{t}") for t in range(150)]
    rows += [(2, 0, None, None), (None, None, "user", "x"), (None, 3, "assistant", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["tree"]: r["formatted"] for r in chat_format.format_conversations(turns).collect()}
    assert [t for _, t in chat_format.read_back(found[1])] == [f"t{t}" for t in range(150)]
    assert chat_format.read_back(found[2]) == [("", "")]
    assert chat_format.read_back(found[None]) == [("user", "x"), ("assistant", "y")]
    assert chat_format.format_conversations(turns.limit(0)).isEmpty()


# 8 ---------------------------------------------------------------------------------


def test_fingerprints(spark, texts):
    ids = [3 * i + 1 for i in range(len(texts))]
    rows = fingerprints.fingerprint(documents(spark, texts, ids), buckets=7).collect()
    by_id = {r["row"]["doc_id"]: r for r in rows}
    order = sorted(ids, reverse=True)
    prints = {}
    for own, following in zip(order, order[1:] + order[:1], strict=True):
        text, after = (texts[(i - 1) // 3] or "" for i in (own, following))
        cut = len(text) // 3
        assert by_id[own]["edited"] == text[: len(text) - cut] + after[:cut]
        assert prints.setdefault(text, by_id[own]["fingerprint"]) == by_id[own]["fingerprint"]
    assert len(set(prints.values())) == len(prints)
    assert len(rows) == len(texts)


def test_likeness_is_that_of_the_pieces():
    draw = np.random.default_rng(2)
    sides = []
    for _ in range(2):
        owner = np.sort(draw.integers(0, 6, 400))
        sides.append((draw.integers(0, 300, 400).astype(np.uint64), owner))
    distinct = []
    for digests, owner in sides:
        pairs = np.unique(np.stack([owner, digests.astype(np.int64)], axis=1), axis=0)
        distinct.append((pairs[:, 1].astype(np.uint64), pairs[:, 0]))
    got = fingerprints.likeness(*distinct, np.arange(6), np.arange(6))
    for i in range(6):
        a, b = (set(d[o == i].tolist()) for d, o in distinct)
        assert abs(got[i] - len(a & b) / len(a | b)) < 1e-12


# 9 ---------------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = quality.judged(docs, labels.where("doc_id % 2 = 0")).select("row.doc_id", "keep")
    held = labels.where("doc_id % 2 = 1").join(found, "doc_id").toPandas()
    bad = (held.quality == 0) | (held.toxic == 1)
    assert (~held.keep[bad]).mean() > 0.85
    assert held.keep[~bad].mean() > 0.99


def test_words_are_picked_at_every_label_share(spark):
    docs = documents(spark, [f"{'vile' if i % 5 else 'kind'} plain words" for i in range(100)])
    for toxic in ("doc_id % 5 > 0", "doc_id % 5 = 0"):  # 80 and 20 % of the labels
        labels = docs.selectExpr("doc_id", "1 AS quality", f"int({toxic}) AS toxic")
        assert len(quality.fit(docs, labels)["picked"])


def test_sparse_sites_keep_the_prior(spark):
    rows = [("big", "a", 0.9, 0.1)] * 300 + [("small", "a", 0.9, 0.1)] + [
        (f"h{i}", "a", 0.1, 0.1) for i in range(50) for _ in range(20)]
    sites = quality.site_rates(spark.createDataFrame(
        rows, "host string, path string, p_low double, p_toxic double"))
    means = sites.means
    found = {r["host"]: r["rate"] for r in sites.sums.select(
        "host", sites.rate("path", "low").alias("rate")).collect()}
    assert found["big"] > found["small"] > means["low"] - 0.01
    assert abs(found["small"] - means["low"]) < abs(found["big"] - means["low"])
    # Without its only document a site has nothing but the prior.
    alone = sites.sums.where("host = 'small'").select(
        sites.rate("path", "low", F.lit(0.9)).alias("rate")).first()["rate"]
    assert abs(alone - means["low"]) < 1e-6


def test_own_evidence_counts_once(spark):
    """A document alone at its site has its own odds and no others."""
    docs = documents(spark, [f"{'vile' if i % 5 == 0 else 'kind'} plain words {i}" for i in range(200)])
    docs = docs.withColumn("source", F.expr("IF(doc_id < 3, concat('s', doc_id), 'many')"))
    labels = docs.where("doc_id > 2").selectExpr(
        "doc_id", "1 AS quality", "int(doc_id % 5 = 0) AS toxic")
    for row in quality.judged(docs, labels).where("row.doc_id < 3").collect():
        assert abs(row["toxic"] - row["p_toxic"]) < 1e-6


def test_odd_rows_are_judged(spark):
    docs = documents(spark, [None, "", "kind words", "kind words", "vile words"] * 8, [
        None if i % 9 == 0 else i // 2 for i in range(40)]).withColumn(
        "source", F.expr("IF(doc_id % 3 = 0, NULL, source)"))
    labels = spark.createDataFrame(
        [(i, i % 2, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, 0)],
        "doc_id long, quality int, toxic int")
    found = quality.judged(docs, labels)
    assert found.count() == 40 and found.where(
        "low IS NULL OR toxic IS NULL OR low <= 0 OR low >= 1 OR keep IS NULL").isEmpty()
    assert quality.judged(docs, labels.limit(0)).where("NOT keep").isEmpty()


# 10 --------------------------------------------------------------------------------


@pytest.mark.parametrize("share", [line_dedup.SHARE, 40, 1])  # all, some and no hot lines
def test_lines(spark, texts, share):
    given = [*texts, "  Same LINE here\t\nx", "same line here\nsame line here", "É long line!",
             "é long line!", "short\nshort", "short"]
    keys = [[line_dedup.line_key(x).decode() for x in (t or "").encode().split(b"\n")]
            for t in (given)]
    holders = {}
    for i, own in enumerate(keys):
        for key in own:
            holders.setdefault(key, []).append(i)
    for row in line_dedup.drop_repeated_lines(documents(spark, given), share=share).collect():
        i = row["row"]["doc_id"]
        lines = (given[i] or "").split("\n")
        kept = [x for x, k in zip(lines, keys[i], strict=True)
                if len(k) < 10 or min(holders[k]) == i]
        assert (row["n_lines"], row["n_dropped"]) == (len(lines), len(lines) - len(kept))
        assert (row["text"] or "") == "\n".join(kept)


# All -------------------------------------------------------------------------------


def test_empty_tables(spark):
    none = documents(spark, [])
    tests = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    lexicon, weights = language_model.fit(none)
    for rows in (
        secret_scan.scan_secrets(none), packing.pack(none), suffix_dedup.drop_repeats(none),
        jaccard_join.jaccard_components(none), decontamination.find_leaks(none, tests),
        language_model.log_likelihoods(none, lexicon, weights), fingerprints.fingerprint(none),
        quality.judged(none, labels), line_dedup.drop_repeated_lines(none),
    ):
        assert rows.isEmpty()


def test_columns_with_dots_in_their_names(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(20).selectExpr(
        "*", "1 AS `a.b`", "'x' AS `c``d`")
    rows = [
        secret_scan.scan_secrets(docs), packing.packed_documents(docs), suffix_dedup.drop_repeats(docs),
        line_dedup.drop_repeated_lines(docs), fingerprints.fingerprint(docs),
    ]
    for found in rows:
        assert found.count() >= 20
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, sf_dir)
        assert found.columns == docs.columns, name
        assert {r["a.b"] for r in found.collect()} == {1}, name


def test_pipeline_takes_each_stage_into_account(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judged(docs, labels).where("keep").select("row.doc_id").collect()
    kept = {r["doc_id"] for r in judged}
    stages = dict(corpus_pipeline.STAGES)
    stage = stages["quality classifier"](spark, docs, sf_dir)
    assert stage.columns == docs.columns
    assert {r["doc_id"] for r in stage.collect()} == kept
    lines = stages["line dedup"](spark, stage, sf_dir)
    assert lines.columns == docs.columns
    rows = sorted(lines.collect(), key=lambda r: r["doc_id"])
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    alone = stages["n-gram Jaccard join"](spark, lines, sf_dir).collect()
    want = first_of_five_word_component([r["text"] for r in rows])
    assert {r["doc_id"] for r in alone} == {
        r["doc_id"] for i, r in enumerate(rows) if want[i] == i}
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    plain = [" " + " ".join(re.findall(r"[^\W_]+", r["text"].lower())) + " " for r in items]
    held = {r["doc_id"] for r in alone if any(
        p in " " + " ".join(re.findall(r"[^\W_]+", r["text"].lower())) + " " for p in plain)}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in alone} - held


def test_packing_encodes_a_word_once():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    found, asked = packing.WordIds(path), []
    encoded = found._encoded
    found._encoded = lambda texts: asked.extend(texts) or encoded(texts)
    found.of([b"Stone river"])
    asked.clear()
    odd = ["stone, RIVER; (stone\x0bx", "", " \t\r\n\x0c", "İ Été\u0085a\x1fb.", "<|X|> Y<|endoftext|>\n",
           " y  "]
    ids, counts = found.of([t.encode() for t in odd])
    assert not {"stone", "river"} & {w for text in asked for w in text.split()}
    whole = Tokenizer.from_file(path)
    wanted = [whole.encode(t, add_special_tokens=False).ids for t in odd]
    assert counts.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def test_sets_that_share_a_passage_do_not_meet(spark):
    passage = " ".join(f"common{i}" for i in range(160))
    rows = [(f"{passage} " + " ".join(f"own{n}x{i}" for i in range(240)),) for n in range(40)]
    rows += [(rows[0][0] + " once more",)]
    found = jaccard_join.mapped(
        spark.createDataFrame(rows, "text string"), jaccard_join.region_rows,
        "region long, c1 long, c2 long, spare long", width=5, percent=80)
    shared = jaccard_join.mapped(
        found.repartition("region").sortWithinPartitions("region", "c1", "c2"),
        jaccard_join.shared_rows, "region long, c1 long, c2 long, spare long")
    crowds = [r["count"] for r in
              jaccard_join.without_spare(shared).distinct().groupBy("region").count().collect()]
    assert crowds and max(crowds) == 2  # the last two sets, which are linked
