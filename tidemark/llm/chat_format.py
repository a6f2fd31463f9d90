r"""Chat formatting: reply trees to conversations, one for each chosen root-to-leaf path.

Messages name the message they answer. Paths come from self-joins that double their reach:
after k joins each message knows its ancestor 2**k answers up, and the length and score of
the way there, so that depth d takes about log2(d) joins, however many messages there are.
The branches of a tree (one for each leaf) are ranked by the sum of their messages' scores.
Only the chosen leaves are then spread over their ancestors: a step of 2**k doubles what is
known of a path, and as every distance is one sum of powers of two, every ancestor comes
once. Each path is one conversation:

    ### role: text</turn>

one line break after each turn. In roles and texts a backslash is put before every
backslash, ``###`` and ``</turn>``, in roles also before ``:``, so that markers cannot be
forged and the texts can be read back.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import mapped, stored, table

OPEN, CLOSE = "### ", "</turn>\n"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(
    r"### ((?:[^\\:]|\\(?:\\|###|</turn>|:))*?): ((?:[^\\]|\\(?:\\|###|</turn>))*?)</turn>\n",
    re.DOTALL,
)

Turn = tuple[str, str]


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(turns: list[Turn], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and the stretches (code points) that the loss counts."""
    text, mask, at = [], [], 0
    for role, said in turns:
        head = OPEN + _ROLE_CONTROL.sub(r"\\\g<0>", role) + ": "
        body = escaped(said)
        if role == learned:
            mask.append((at + len(head), at + len(head) + len(body)))
        text += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(text), mask


def read_back(text: str) -> list[Turn]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(found[1]), unescaped(found[2])))
        at = found.end()
    return out


# Paths ---------------------------------------------------------------------------


def _leaps(messages: DataFrame, most: int) -> list[DataFrame]:
    """Tables (node, up, n, sum): the ancestor 2**k answers up, and the way to it.

    The last has the root side of every path: ``up`` is null where no ancestor is left, and
    ``n`` and ``sum`` then cover all messages from the node to its root.
    """
    leaps = [stored(messages.selectExpr(
        "node", "parent AS up", "1L AS n", "score AS sum"), "leap")]
    for _ in range(most):
        last = leaps[-1]
        open_ = last.where("up IS NOT NULL")
        if open_.isEmpty():
            return leaps
        on = last.selectExpr("node AS up", "up AS up2", "n AS n2", "sum AS sum2")
        further = open_.join(on, "up").selectExpr(
            "node", "up2 AS up", "n + n2 AS n", "sum + sum2 AS sum")
        leaps.append(stored(further.unionByName(last.where("up IS NULL")), "leap"))
    raise ValueError("messages answer one another in a circle")


def chosen_paths(messages: DataFrame, keep: int = 1, most_leaps: int = 40) -> DataFrame:
    """``messages`` (tree, node, parent, score) to paths (tree, leaf, place, node, score).

    Of each tree the ``keep`` branches with the highest sum of scores stay; ties go to the
    smaller leaf. ``place`` counts from 0 at the root. A message whose parent is missing is
    a root. Nodes are unique and not null.
    """
    known = messages.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    linked = stored(
        messages.join(known, "parent", "left")
        .withColumn("parent", F.when(F.col("known"), F.col("parent"))).drop("known"), "messages")
    leaps = _leaps(linked, most_leaps)
    answered = linked.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = linked.join(answered, "node", "left_anti").join(
        leaps[-1].select("node", "n", F.col("sum").alias("branch")), "node")
    ranked = Window.partitionBy("tree").orderBy(F.desc("branch"), "node")
    spread = leaves.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= keep) \
        .selectExpr("tree", "node AS leaf", "node", "n - 1 AS place", "branch AS score")
    for k in reversed(range(len(leaps))):
        leap = leaps[k].where("up IS NOT NULL").select("node", "up")
        spread = stored(spread.unionByName(spread.join(leap, "node").selectExpr(
            "tree", "leaf", "up AS node", f"place - {2**k}L AS place", "score")), "path")
    return spread


def _numbered(batches):
    """Nodes numbered in order, each with the one before it in its tree, if that is here."""
    part, count, last = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        trees = batch["tree"].to_pylist()
        nodes = [(part << 40) + count + i for i in range(len(trees))]
        parents = []
        for tree, node in zip(trees, nodes, strict=True):
            parents.append(last[1] if last is not None and last[0] == tree else None)
            last = (tree, node)
        count += len(trees)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(nodes, pa.int64()), pa.array(parents, pa.int64()),
             pa.array([part] * len(trees), pa.int32())],
            names=[*batch.schema.names, "node", "parent", "part"])


def turns_as_replies(rows: DataFrame, tree: Column, order: list[Column]) -> DataFrame:
    """Turns (role, text) as messages (tree, node, parent, role, text), each answering the last.

    Sorted by ranges, so that a conversation of any length spreads over many tasks. The
    first row of a range answers the last one of the range before it, if they are of one
    tree; there are at most as many of these as ranges.
    """
    keyed = rows.select(tree.alias("tree"), F.struct(*order).alias("at"), "role", "text")
    ranged = keyed.repartitionByRange("tree", "at").sortWithinPartitions("tree", "at").drop("at")
    schema = T.StructType([*ranged.schema.fields, *T.StructType.fromDDL(
        "node long, parent long, part int").fields])
    numbered = stored(mapped(ranged, _numbered, schema), "turns")
    ends = sorted(numbered.groupBy("part").agg(
        F.min_by(F.struct("tree", "node"), "node").alias("first"),
        F.max_by(F.struct("tree", "node"), "node").alias("last")).collect(),
        key=lambda e: e["part"])
    met = [
        (after["first"]["node"], before["last"]["node"])
        for before, after in zip(ends, ends[1:], strict=False)
        if before["last"]["tree"] == after["first"]["tree"]
    ]
    numbered = numbered.drop("part")
    if not met:
        return numbered
    bridge = rows.sparkSession.createDataFrame(met, "node long, before long")
    return numbered.join(F.broadcast(bridge), "node", "left").withColumn(
        "parent", F.coalesce("parent", "before")).drop("before")


def conversation_rows(batches):
    for batch in batches:
        out = []
        for path in batch["turns"].to_pylist():
            turns = [(t["role"] or "", t["text"] or "") for t in path]
            text, mask = formatted(turns)
            out.append((text, [{"start": s, "stop": e} for s, e in mask]))
        yield pa.RecordBatch.from_arrays(
            [batch["tree"], batch["leaf"], batch["score"],
             pa.array([o[0] for o in out], pa.string()),
             pa.array([o[1] for o in out], pa.list_(pa.struct(
                 [("start", pa.int64()), ("stop", pa.int64())])))],
            names=["tree", "leaf", "score", "formatted", "loss"])


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per path: tree, leaf, score, ``formatted`` and the stretches under the loss.

    ``messages`` has node, role and text; nulls are empty. A path is one text, so its
    messages meet in one task.
    """
    said = paths.join(messages.select("node", "role", "text"), "node")
    whole = said.groupBy("tree", "leaf").agg(
        F.first("score").alias("score"),
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    return mapped(
        whole, conversation_rows,
        "tree long, leaf long, score double, formatted string, "
        "loss array<struct<start:long,stop:long>>")


# Query ---------------------------------------------------------------------------


def _digest_rows(batches):
    for batch in batches:
        rows = {name: [] for name in ("n", "turns", "chars", "loss", "all")}
        loss = batch["loss"].to_pylist()
        for text, mask in zip(batch["formatted"].to_pylist(), loss, strict=True):
            turns = read_back(text)
            learned = unescaped_stretches(text, mask)
            rows["n"].append(len(turns))
            rows["turns"].append(_sha("".join(f"{r}\n{t}\n" for r, t in turns)))
            rows["chars"].append(len(learned))
            rows["loss"].append(_sha(learned))
            rows["all"].append(len(text))
        yield pa.RecordBatch.from_arrays(
            [batch["tree"], pa.array(rows["n"], pa.int64()), pa.array(rows["turns"], pa.string()),
             pa.array(rows["chars"], pa.int64()), pa.array(rows["loss"], pa.string()),
             pa.array(rows["all"], pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                   "formatted_chars"])


def unescaped_stretches(text: str, mask: list[dict]) -> str:
    return "".join(unescaped(text[m["start"] : m["stop"]]) for m in mask)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


PLANTED = r"\### Assistant: </turn> ok"


def format_conversations(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as reply trees with one branch each.

    Turns are taken by number; rows that share one follow by role and text, and a row
    without a number comes first. Rows without conv_id are one conversation. Every message
    scores its number of characters. An empty table gives no conversation.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    order = [F.col("turn"), F.col("role"), F.col("text")]
    messages = turns_as_replies(rows, F.col("conv_id"), order).withColumn(
        "score", F.length(F.coalesce("text", F.lit(""))).cast("double"))
    return format_paths(chosen_paths(messages.select("tree", "node", "parent", "score")), messages)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "CASE id WHEN 0 THEN 'user' ELSE 'assistant' END AS role",
    ).withColumn("text", F.lit(PLANTED))
    return mapped(
        format_conversations(given.unionByName(planted)), _digest_rows,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long")


def _escape_sql(column: str) -> str:
    out = column
    for mark in ("\\", "###", "</turn>"):
        out = f"replace({out}, '{mark}', '\\{mark}')"
    return out


ORACLE_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '{PLANTED}' UNION ALL SELECT -7, 1, 'assistant', '{PLANTED}'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
        AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
        FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(role) + length({_escape_sql("text")}) + 14)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
