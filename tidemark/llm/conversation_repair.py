"""Conversation structure repair: the cheapest edits that make the roles alternate.

A conversation is a path through a lattice of (rows taken, roles so far): keep, rerole or
delete a row, or insert an empty turn. A bidirectional Dijkstra searches it: a forward heap from
the first row and a reverse heap from the end meet, all crossings of least cost are finished,
and of these the least audit wins. A node needs only its least label: an audit says which nodes
it passes, so two audits of one cost between the same two nodes are never one the start of the other.

Long conversations are searched in blocks of ``BLOCK`` rows, from each state before a block to
each state after it; what the open audits have in common is written out after each block.

Rows move twice, each time sorted by conversation and turn and worked on as a stream: first
without their texts (flags and a digest), which gives the edits; then the texts meet the edits,
a row in front of the rows of its conversation. So no conversation's texts are held in memory;
its digests and a byte a row are. A conversation stays in one task, as the digest of its repaired
text can only be taken in order.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, table

#: Rows of a conversation searched at once.
BLOCK = 64

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
#: Added for a truncated row that stays.
TRUNCATED_COST = 1

#: What a row can be: good, ending without a full stop, or to be deleted.
GOOD, TRUNCATED, LOST = range(3)
_FAULTS = 3
INITIALS = "sua"

#: Roles so far: none, the system's turn, then the user's or the assistant's last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Where a conversation may end.
ENDS = (START, ASSISTANT)
#: Where a turn of the user or the assistant leads: only one of the two can be next.
TURN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {
    (START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
    (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}

SPACES = " \t\n\v\f\r"
STOPS = (".", "!", "?")


def row_code(initial: str, fault: int) -> int:
    place = INITIALS.find(initial) if initial else -1
    return (place if place >= 0 else len(INITIALS)) * _FAULTS + fault


# The search ----------------------------------------------------------------------


@cache
def _edges(code: int, state: int) -> tuple[tuple[int, str, int], ...]:
    """Cost, edit and next state of each way to take a row."""
    initial, fault = (INITIALS + "-")[code // _FAULTS], code % _FAULTS
    found = [(COST[DELETE], DELETE, state)]
    if fault != LOST:
        stays = TRUNCATED_COST if fault == TRUNCATED else 0
        if (state, initial) in _KEPT:
            found.append((COST[KEEP] + stays, KEEP, _KEPT[state, initial]))
        found.append((COST[REROLE] + stays, REROLE, TURN[state]))
    return tuple(found)


@cache
def _back_edges(code: int, state: int) -> tuple[tuple[int, str, int], ...]:
    return tuple(
        (cost, edit, before) for before in STATES
        for cost, edit, after in _edges(code, before) if after == state)


def _ahead(codes: bytes, place: int, state: int):
    if place < len(codes):
        for cost, edit, after in _edges(codes[place], state):
            yield cost, edit, place + 1, after
    yield COST[INSERT], INSERT, place, TURN[state]


def _behind(codes: bytes, place: int, state: int):
    if place:
        for cost, edit, before in _back_edges(codes[place - 1], state):
            yield cost, edit, place - 1, before
    for before in STATES:
        if TURN[before] == state:
            yield COST[INSERT], INSERT, place, before


@lru_cache(maxsize=1 << 16)
def cheapest(codes: bytes, entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and audit of the best way from ``entry`` to one of ``exits``, or None without one.

    Edits without a cost lead to the next row, so that of nodes of equal cost those fewer rows
    away from their end are settled first; then a settled node's label is final.
    """
    count = len(codes)
    labels = ({(0, entry): (0, "")}, {(count, state): (0, "") for state in exits})
    heaps = ([(0, 0, entry)], [(0, 0, state) for state in exits])
    settled: tuple[set, set] = (set(), set())
    heapq.heapify(heaps[1])
    least = 0 if labels[0].keys() & labels[1].keys() else inf
    while all(heaps) and heaps[0][0][0] + heaps[1][0][0] <= least:
        side = int(heaps[1][0][0] < heaps[0][0][0])
        own, other = labels[side], labels[1 - side]
        cost, rows, state = heapq.heappop(heaps[side])
        node = (count - rows if side else rows, state)
        if node in settled[side]:
            continue
        settled[side].add(node)
        audit = own[node][1]
        for more, edit, place, to in (_behind if side else _ahead)(codes, *node):
            label = (cost + more, edit + audit if side else audit + edit)
            reached = (place, to)
            if reached in own and own[reached] <= label:
                continue
            own[reached] = label
            heapq.heappush(heaps[side], (label[0], count - place if side else place, to))
            if reached in other:
                least = min(least, label[0] + other[reached][0])
    met = [
        (first[0] + labels[1][node][0], first[1] + labels[1][node][1])
        for node, first in labels[0].items() if node in labels[1]
    ]
    return min(met, default=None)


def cheapest_edits(codes: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and least audit of the edits that repair a conversation."""
    if len(codes) <= block:
        return cheapest(codes, START, ENDS)
    written, live = [], {START: (0, "")}
    for at in range(0, len(codes), block):
        part, reached = codes[at : at + block], {}
        for state, (cost, audit) in live.items():
            for to in STATES:
                found = cheapest(part, state, (to,))
                if found:
                    label = (cost + found[0], audit + found[1])
                    reached[to] = min(reached.get(to, label), label)
        shared = os.path.commonprefix([audit for _, audit in reached.values()])
        written.append(shared)
        live = {to: (cost, audit[len(shared):]) for to, (cost, audit) in reached.items()}
    cost, audit = min(live[state] for state in ENDS if state in live)
    return cost, "".join(written) + audit


# Rows of conversations as streams ------------------------------------------------


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _packed(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of the rows, of some thousand rows or a few megabytes of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= 4096 or size > 1 << 22:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _plan(conv_id, rows: Iterator[tuple]) -> tuple:
    codes, seen = bytearray(), set()
    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
    first = last = None
    turns = illegal = 0
    before = None
    for _, live, turn, digest, initial, fault in rows:
        if not live:
            continue
        if turn is not None and turn != last:
            first, last, turns = turn if first is None else first, turn, turns + 1
        if before is not None and before + initial not in ("su", "ua", "au"):
            illegal += 1
        before = initial
        known, _ = digest in seen, seen.add(digest)
        fault = "blank" if fault == "blank" else "duplicate" if known else fault
        if fault:
            faults[fault] += 1
        codes.append(row_code(
            initial, GOOD if not fault else TRUNCATED if fault == "truncated" else LOST))
    gaps = min(last - first + 1 - turns, 2**63 - 1) if turns else 0
    cost, audit = cheapest_edits(bytes(codes))
    return conv_id, gaps, *faults.values(), illegal, cost, audit


def _by_conversation(rows: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Each conversation with a stream of its rows, to be used up before the next one."""
    row = next(rows, None)
    while row is not None:
        conv_id = row[0]

        def own():
            nonlocal row
            yield row
            row = next(rows, None)
            while row is not None and row[0] == conv_id:
                yield row
                row = next(rows, None)

        stream = own()
        yield conv_id, stream
        for _ in stream:
            pass


def plan_rows(batches, id_type):
    schema = _PLAN_ARROW.insert(0, pa.field("conv_id", id_type))
    found = (_plan(*conversation) for conversation in _by_conversation(_rows(batches)))
    yield from _packed(found, schema)


def _turns(audit: str, rows: Iterator[tuple]) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of each turn of the repaired conversation."""
    state, at = START, 0

    def inserted():
        nonlocal state, at
        while at < len(audit) and audit[at] == INSERT:
            state, at = TURN[state], at + 1
            yield INSERT, ROLE[state], ""

    for row in rows:
        role, text = row[-2:]
        yield from inserted()
        edit, at = audit[at], at + 1
        if edit == KEEP:
            state = _KEPT[state, role[:1]]
            yield edit, role, text
        elif edit == REROLE:
            state = TURN[state]
            yield edit, ROLE[state], text
    yield from inserted()


def _repaired(batches) -> Iterator[tuple[tuple, Iterator[tuple[str, str, str]]]]:
    for _, rows in _by_conversation(_rows(batches)):
        plan = next(rows)
        yield plan, _turns(plan[_AUDIT], rows)


def report_rows(batches, id_type):
    """A conversation's plan, and the digest of its repaired turns as they stream by."""

    def found():
        for plan, turns in _repaired(batches):
            digest = hashlib.sha256()
            for number, (_, role, text) in enumerate(turns):
                digest.update(f"{chr(10) if number else ''}{role}:{text}".encode())
            yield plan[0], *plan[_FIRST : _AUDIT + 1], digest.hexdigest()

    schema = _PLAN_ARROW.insert(0, pa.field("conv_id", id_type))
    yield from _packed(found(), schema.append(pa.field("repaired_sha256", pa.string())))


def turn_rows(batches, id_type):
    def found():
        for plan, turns in _repaired(batches):
            for number, (edit, role, text) in enumerate(turns):
                yield plan[0], number, role, text, edit

    schema = pa.schema([
        ("conv_id", id_type), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("edit", pa.string())])
    yield from _packed(found(), schema)


# Spark ---------------------------------------------------------------------------

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_PLAN_ARROW = pa.schema([*((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])
PLAN = ", ".join([*(f"{c} long" for c in _COUNTS), "audit string"])
# Where a plan's columns begin in a row of the second stream, and where its audit is.
_FIRST = 4
_AUDIT = _FIRST + len(_COUNTS)


def _sorted(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *keys)


def _schema(rows: DataFrame, more: str) -> T.StructType:
    return T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(more).fields])


def _id_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["conv_id"].dataType)


def _clean(rows: DataFrame) -> DataFrame:
    """The columns worked on: nulls are one space, and a digest of role and text."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"), text("text").alias("text"))
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumn("digest", F.unhex(F.md5(whole.cast("binary"))))


def plans(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation: its faults, and cost and audit of the cheapest edits.

    ``every`` names conversations to report even if ``rows`` has none of their rows.
    """
    clean = _clean(rows)
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    fault = F.when(solid == "", "blank").when(
        ~F.substring(solid, -1, 1).isin(*STOPS), "truncated")
    light = clean.select(
        "conv_id", F.lit(True).alias("live"), "turn", "digest",
        F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    if every is not None:
        marks = every.select("conv_id").distinct().withColumn("live", F.lit(False))
        light = light.unionByName(marks, allowMissingColumns=True)
    return mapped(
        _sorted(light, "live", "turn", "digest"), plan_rows, _schema(rows, PLAN),
        id_type=_id_type(rows))


def _with_plans(rows: DataFrame, every: DataFrame | None) -> DataFrame:
    """The rows in order, each conversation behind its plan."""
    found = plans(rows, every).select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("binary").alias("digest"), *_COUNTS, "audit",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = _clean(rows).withColumn("kind", F.lit(1))
    both = found.unionByName(texts, allowMissingColumns=True)
    return _sorted(both, "kind", "turn", "digest")


def repair_report(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Per conversation its faults, the cheapest edits and the digest of the repaired text.

    ``rows`` has conv_id, turn, role and text; other columns are left out. A conversation's
    rows are taken by turn, those without one first; rows of one turn by a digest of role and
    text, so that equal ones lie side by side. Null roles and texts count as one space; rows
    without a conv_id are one conversation. A row's first fault counts: blank, duplicate (an
    earlier row has its role and text), truncated. A row without a role cannot be kept, only
    deleted or given one. An empty table gives no rows. Texts may be of any length.
    """
    return mapped(
        _with_plans(rows, every), report_rows, _schema(rows, f"{PLAN}, repaired_sha256 string"),
        id_type=_id_type(rows))


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), role, text and the turn's edit.

    Deleted rows are left out, and a conversation that loses all its rows with them.
    """
    return mapped(
        _with_plans(rows, None), turn_rows,
        _schema(rows, "place long, role string, text string, edit string"),
        id_type=_id_type(rows))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a hash of conversation and turn: dropped, emptied, cut, doubled, reroled."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        kind.alias("kind")).where("kind <> 0")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(
            F.col("kind") == 2, F.translate("text", "".join(STOPS), ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(damaged(conversations), conversations)


# The same by forward steps over all states at once; up to two turns can be worth inserting
# before a row. The hash is spelled out bit by bit.
ORACLE_SQL = r"""
WITH RECURSIVE cells AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS label
    FROM conversations
), hashed AS (
    SELECT *, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(
        list_transform(string_split(label, ''), lambda ch: list_prepend(
            CAST(ascii(ch) AS BIGINT),
            list_transform(range(8), lambda bit: CAST(-1 AS BIGINT)))))),
        lambda sum, x: CASE WHEN x >= 0 THEN xor(sum, x)
            ELSE xor(sum >> 1, (sum & 1) * 3988292384) END)) % 20 AS kind
    FROM cells
), broken AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE kind <> 0
), placed AS (
    SELECT *, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
        row_number() OVER (
            PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
    FROM broken
), judged AS (
    SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
            WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
        role[1:1] AS initial, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM placed
), convs AS (
    SELECT DISTINCT conv_id FROM conversations
), lengths AS (
    SELECT c.conv_id, count(j.place) AS rows FROM convs c
    LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id
), inserts(state, edits, state2, added) AS (
    VALUES ('0', '', '0', ''), ('s', '', 's', ''), ('u', '', 'u', ''), ('a', '', 'a', ''),
        ('0', 'I', 'u', chr(10) || 'user:'), ('s', 'I', 'u', chr(10) || 'user:'),
        ('u', 'I', 'a', chr(10) || 'assistant:'), ('a', 'I', 'u', chr(10) || 'user:'),
        ('0', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:'),
        ('s', 'II', 'a', chr(10) || 'user:' || chr(10) || 'assistant:')
), keeps(state, initial, state2) AS (
    VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')
), turns(state, role, state2) AS (
    VALUES ('0', 'user', 'u'), ('s', 'user', 'u'), ('u', 'assistant', 'a'), ('a', 'user', 'u')
), paths AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, '0' AS state, CAST(0 AS BIGINT) AS cost,
        '' AS audit, '' AS lines
    FROM convs
    UNION ALL
    SELECT conv_id, place, state, cost, audit, lines FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS rank FROM (
            WITH opened AS (
                SELECT p.conv_id, p.place + 1 AS place, i.state2 AS state,
                    p.cost + 2 * length(i.edits) AS cost, p.audit || i.edits AS audit,
                    p.lines || i.added AS lines, j.role, j.text, j.initial, j.fault,
                    CASE WHEN j.fault = 'truncated' THEN 1 ELSE 0 END AS more
                FROM paths p JOIN inserts i ON i.state = p.state
                JOIN judged j ON j.conv_id IS NOT DISTINCT FROM p.conv_id AND j.place = p.place + 1
            )
            SELECT conv_id, place, state, cost + 3 AS cost, audit || 'D' AS audit, lines FROM opened
            UNION ALL
            SELECT conv_id, place, k.state2, cost + more, audit || 'K',
                lines || chr(10) || role || ':' || text
            FROM opened o JOIN keeps k ON k.state = o.state AND k.initial = o.initial
            WHERE fault IS NULL OR fault = 'truncated'
            UNION ALL
            SELECT conv_id, place, t.state2, cost + 2 + more, audit || 'R',
                lines || chr(10) || t.role || ':' || text
            FROM opened o JOIN turns t ON t.state = o.state
            WHERE fault IS NULL OR fault = 'truncated'
        )
    ) WHERE rank = 1
), ended AS (
    SELECT p.conv_id, p.cost + 2 * length(i.edits) AS cost, p.audit || i.edits AS audit,
        p.lines || i.added AS lines
    FROM paths p JOIN lengths l ON l.conv_id IS NOT DISTINCT FROM p.conv_id AND l.rows = p.place
    JOIN inserts i ON i.state = p.state
    WHERE i.state2 IN ('0', 'a')
), best AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS rank FROM ended)
    WHERE rank = 1
), faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT b.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank,
    coalesce(f.duplicate, 0) AS duplicate, coalesce(f.truncated, 0) AS truncated,
    coalesce(f.illegal, 0) AS illegal, b.cost, b.audit, sha256(b.lines[2:]) AS repaired_sha256
FROM best b LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id
"""
