"""Operator 4: chat formatting of reply trees (DataFrame functions only).

Messages form reply trees (``tree``, ``node``, ``parent``, ``score``). Ancestors
are found by self-joins that double the distance each round, so that a thread
of n messages takes log2(n) rounds. A branch is a root-to-leaf path; its score
is the sum of its messages' scores, and the best ``top`` branches of a tree are
each formatted as one conversation, with the spans of the text that a model is
trained on.

A turn is ``### role:``, a line break, the text and ``</turn>`` with a line break.
In texts and roles ``\\`` becomes ``\\b``, ``##`` becomes ``#\\h`` and ``</turn``
becomes ``<\\sturn`` (in roles a line break becomes ``\\n`` too), so that no text
can hold a mark and every text can be read back.

Defined results: a null text or role is empty; a parent that is missing makes
the message a root; a message below a reply cycle hangs from the cycle's
smallest node, which counts as a root; an empty table gives an empty one. A
conversation becomes one row, whatever its length.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refyield.llm.common import staged, table, text_or_empty

#: The template's marks.
OPEN, AFTER_ROLE, CLOSE = "### ", ":\n", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("##", "#\\h"), ("</turn", "<\\sturn"))
LINE = ("\n", "\\n")


def escape(text: Column, *more: tuple[str, str]) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), [*ESCAPES, *more], text)


def unescape(text: Column, *more: tuple[str, str]) -> Column:
    back = [*more, ("</turn", "<\\sturn"), ("#", "\\h"), ("\\", "\\b")]
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), back, text)


def _ancestors(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, parent, score) -> every node's whole-path score, and the
    tables of the 1st, 2nd, 4th .. ancestors (tree, node, up)."""
    known = nodes.select(F.col("tree").alias("_t"), F.col("node").alias("_p"))
    linked = nodes.join(known, (F.col("tree") == F.col("_t")) & (F.col("parent") == F.col("_p")), "left").select(
        "tree", "node", F.when(F.col("_p") != F.col("node"), F.col("_p")).alias("up"), F.col("score").cast("double").alias("total"), F.col("node").alias("low")
    )
    now = staged(linked, "chat-up")
    longest = now.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    rounds = max(1, math.ceil(math.log2(longest + 1)))

    def doubled(now: DataFrame) -> DataFrame:
        above = now.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_u"), F.col("total").alias("_s"), F.col("low").alias("_l"))
        return now.join(above, (F.col("tree") == F.col("_t")) & (F.col("up") == F.col("_n")), "left").select(
            "tree", "node", F.col("_u").alias("up"), (F.col("total") + F.coalesce("_s", F.lit(0.0))).alias("total"), F.least("low", "_l").alias("low")
        )

    first, jumps = now, []
    for _ in range(rounds):
        jumps.append(now.filter("up IS NOT NULL").select("tree", "node", "up"))
        now = staged(doubled(now), "chat-up")
    stuck = now.filter("up IS NOT NULL")
    if stuck.isEmpty():
        return now.select("tree", "node", "total"), jumps
    # the nodes that nothing smaller stands above start trees of their own
    cut = stuck.filter("low = node").select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    opened = first.join(cut, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left").select(
        "tree", "node", F.when(F.col("_n").isNull(), F.col("up")).alias("parent"), F.col("total").alias("score")
    )
    return _ancestors(opened)


def best_paths(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, node, parent, score) -> (tree, branch, node, up_from_leaf): the
    messages of each tree's ``top`` best branches (ties: smallest leaf)."""
    nodes = staged(nodes.select("tree", "node", "parent", "score"), "chat-nodes")
    totals, jumps = _ancestors(nodes)
    inner = jumps[0].select(F.col("tree").alias("_t"), F.col("up").alias("_n")).distinct()
    leaves = totals.join(inner, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")), "left_anti")
    best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
    paths = (
        leaves.withColumn("branch", F.row_number().over(best))
        .filter(F.col("branch") <= top)
        .select("tree", "branch", "node", F.lit(0).cast("long").alias("up_from_leaf"))
    )
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "up")
        higher = paths.join(step, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n"))).select(
            "tree", "branch", F.col("up").alias("node"), (F.col("up_from_leaf") + 2**k).alias("up_from_leaf")
        )
        paths = staged(paths.unionByName(higher), "chat-paths")
    return paths


def format_branches(messages: DataFrame, paths: DataFrame, trained: str = "assistant") -> DataFrame:
    """Messages (tree, node, role, text) on ``paths`` -> (tree, branch, formatted,
    loss_spans): spans of characters (start, length) of the trained role's texts."""
    role, text = F.coalesce("role", F.lit("")), text_or_empty()
    m = messages.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), role.alias("_role"), text.alias("_text"))
    on_path = paths.join(m, (F.col("tree") == F.col("_t")) & (F.col("node") == F.col("_n")))
    head = F.concat(F.lit(OPEN), escape(F.col("_role"), LINE), F.lit(AFTER_ROLE))
    turns = on_path.select(
        "tree", "branch", "up_from_leaf", (F.col("_role") == trained).alias("trained"), head.alias("head"), escape(F.col("_text")).alias("body")
    )
    path = Window.partitionBy("tree", "branch").orderBy(F.desc("up_from_leaf"))
    width = F.length("head") + F.length("body") + len(CLOSE)
    turns = turns.withColumn("_at", F.coalesce(F.sum(width).over(path.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    turn = F.struct(
        (-F.col("up_from_leaf")).alias("pos"),
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        F.when(F.col("trained"), F.struct((F.col("_at") + F.length("head")).alias("start"), F.length("body").alias("length"))).alias("span"),
    )
    grouped = turns.groupBy("tree", "branch").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return grouped.select(
        "tree",
        "branch",
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("t", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    parts = F.split(formatted, CLOSE)
    header = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substring(header(p), F.lit(len(OPEN) + 1), F.length(header(p)) - len(OPEN) - 1), LINE).alias("role"),
            unescape(F.substring(p, F.length(header(p)) + 2, F.length(p))).alias("text"),
        ),
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["length"])))


def conversation_nodes(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> messages that each reply to the one before
    (by turn, then role and text), as (tree, node, parent, score, role, text)."""
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.select(
        tree.alias("tree"), "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(1.0).alias("score"), "role", "text"
    )


def op4_chat_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted, written and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = "\\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(trap).alias("text"),
    )
    messages = staged(conversation_nodes(rows.unionByName(planted)), "chat-messages")
    out = staged(format_branches(messages, best_paths(messages)), "chat-formatted")
    read = out.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"), loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return read.select(
        F.when(F.col("tree") != "null", F.substring("tree", 2, 20).cast("long")).alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(replace(replace(replace(replace(role, '\', '\b'), '##', '#\h'), '</turn', '<\sturn'), chr(10), '\n'))
           + length(replace(replace(replace(text, '\', '\b'), '##', '#\h'), '</turn', '<\sturn'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
