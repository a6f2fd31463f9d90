"""Conversation repair against all edits tried, and the query against its SQL."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tests.compare import connect, difference
from tidemark.llm import conversation_repair as repair

ROWS = "conv_id long, turn long, role string, text string, live boolean, `a.b` string"
WANTED = re.compile(r"(s?(ua)+)?")


def conversations(spark, rows):
    return spark.createDataFrame([(*r, True, "x") for r in rows], ROWS)


def cheapest(rows):
    """Cost and audit of the repair of (initial, fault) rows, by trying edits in order of cost."""
    heap, best = [(0, "", 0, "")], None
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if best and cost > best[0]:
            return best
        if at == len(rows) and WANTED.fullmatch(roles):
            best = min(best or (cost, audit), (cost, audit))
        if not WANTED.fullmatch(roles) and not WANTED.fullmatch(roles + "a") and not \
                WANTED.fullmatch(roles + "ua"):
            continue
        if at < len(rows):
            initial, fault = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + more, audit + "K", at + 1, roles + (initial or "-")))
                for x in "ua":
                    heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, roles + x))
        if cost <= 2 * len(rows) + 4:
            for x in "ua":
                heapq.heappush(heap, (cost + 2, audit + "I", at, roles + x))
    return best


def code(initial, fault):
    kinds = {None: repair.GOOD, "truncated": repair.TRUNCATED}
    return repair.row_code(initial, kinds.get(fault, repair.LOST))


def test_search_equals_all_edits_tried():
    draw = random.Random(1)
    for _ in range(250):
        rows = [(draw.choice(["s", "u", "a", "u", "a", "x", ""]),
                 draw.choice([None, None, "truncated", "blank"])) for _ in range(draw.randint(0, 4))]
        codes = bytes(code(*r) for r in rows)
        want = cheapest(rows)
        assert repair.cheapest_edits(codes) == want, rows
        for block in (1, 2, 3):
            assert repair.cheapest_edits(codes, block) == want, (rows, block)


def test_blocks_do_not_change_long_repairs():
    draw = random.Random(2)
    for _ in range(20):
        codes = bytes(draw.choice([0, 3, 3, 4, 5, 6, 6, 7, 9]) for _ in range(draw.randint(65, 400)))
        assert repair.cheapest_edits(codes) == repair.cheapest_edits(codes, 10_000)


def blank(text):
    return not text.strip(" \t\n\v\f\r")


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, text) of ordered rows."""
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.rstrip(" \t\n\v\f\r")
        faults.append(
            "blank" if not solid else "duplicate" if (role, text) in seen
            else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = repair.cheapest_edits(
        bytes(code(i, f) for i, f in zip(initials, faults, strict=True)))
    out, left, so_far = [], list(rows), ""
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else (None, "")
        if edit in "IR":
            role = "assistant" if so_far.endswith("u") else "user"
        if edit != "D":
            out.append(f"{role}:{text}")
            so_far += role[:1]
    assert WANTED.fullmatch(so_far)
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, "\n".join(out))


def made(seed):
    draw = random.Random(seed)
    rows = []
    for conv in range(120):
        turn = draw.randint(-3, 3)
        for _ in range(draw.choice([1, 2, 3, 4, 6, 9, 150 if conv == 5 else 3])):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"])
            text = draw.choice([None, "", " \n", "Hi.", "Hi", "né? ", f"t{turn}!", "x" * 5000 + "."])
            rows.append((conv if conv else None, turn, role, text))
            turn += draw.choice([1, 1, 1, 2])
    return rows + [(500, None, "user", "a."), (500, None, "user", "a."), (500, 4, "assistant", "b.")]


def expected(rows, damage):
    by_conv = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        own = by_conv.setdefault(conv, [])
        label = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(label.encode()) % 20 if damage else 9
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        out[conv] = brute(own)
    return out


def test_report_and_turns_equal_brute_force(spark):
    rows = made(3)
    want = expected(rows, damage=False)
    table = conversations(spark, rows)
    found = {r["conv_id"]: tuple(r)[1:] for r in repair.repair_report(table).collect()}
    assert found == {
        c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest()) for c, w in want.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(table).collect(), key=lambda r: r["place"]):
        turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {c: "\n".join(t) for c, t in turns.items()} == {c: w[-1] for c, w in want.items() if w[-1]}


def test_the_query_equals_brute_force_on_odd_rows(spark, tmp_path):
    rows = made(4)
    conversations(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {r["conv_id"]: tuple(r)[1:]
             for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert found == {
        c: (*w[:-1], hashlib.sha256(w[-1].encode()).hexdigest())
        for c, w in expected(rows, damage=True).items()}


def test_conversations_that_lose_all_rows_and_empty_tables(spark, tmp_path):
    conv = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = conversations(spark, [(conv, 0, "user", "Hi.")])
    rows.write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = repair.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    none = conversations(spark, [])
    assert repair.repair_report(none).count() == repair.repaired_turns(none).count() == 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_the_query_equals_its_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    found = difference(
        spark, connect(sf_dir), repair.op13_conversation_repair, repair.ORACLE_SQL, sf_dir)
    assert not found, found
