"""Chat formatting of reply trees (operator 10).

Messages are nodes with a parent.  Self-joins double the reach of each node's
link to its ancestors (2, 4, 8, ... steps up) until every link is past its
root, which takes about log2 of the longest thread.  The same links give each
leaf the score of its path (the sum over its messages) and, walked from long
to short, all nodes of the chosen paths.  All joins are on (conversation,
node), so a conversation with very many messages spreads over all tasks; only
the messages of one chosen path meet, as they become one text.

Format of a turn: ``<turn>### role: text</turn>`` and a line end.  In roles
and texts ``\\``, ``<``, ``#`` (and ``:`` in roles) are written ``\\b``,
``\\l``, ``\\h``, ``\\c``, so no text can hold a control string and reading back
restores every character.  The loss mask is the spans of the assistant texts.

Null roles and texts are empty.  Ties of score go to the least leaf; a missing
parent makes a root; messages on a cycle have no path.  Repeated rows of a
thread are turns of their own.  An empty table gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .frames import digest, table, written

OPEN, HEAD, MID, CLOSE = "<turn>", "### ", ": ", "</turn>\n"
TEXT_ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*TEXT_ESCAPES, (":", "\\c"))
LOSS_ROLE = "assistant"


def escape(c: Column, pairs=TEXT_ESCAPES) -> Column:
    for plain, code in pairs:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column, pairs=TEXT_ESCAPES) -> Column:
    for plain, code in reversed(pairs):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def threads(conversations: DataFrame) -> DataFrame:
    """Nodes of linear threads: each row answers the row before it by turn.

    Rows of equal turn are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id", F.row_number().over(order).cast("long").alias("node"), "role", "text",
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def _links(nodes: DataFrame) -> list[DataFrame]:
    """For k = 0, 1, ...: each node's ancestor 2**k steps up (null past the
    root) and the score of the nodes passed."""
    own = nodes.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("gained"))
    known = nodes.select(F.col("conv_id").alias("_c"), F.col("node").alias("_n"))
    level = written(own.join(
        known, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("parent") == F.col("_n")), "left"
    ).select("conv_id", "node", F.col("_n").alias("up"), "gained"), "reply-links")
    levels, reach, total = [level], 1, level.count()
    while reach < total and not level.where("up is not null").isEmpty():
        far = level.select(F.col("conv_id").alias("_c"), F.col("node").alias("_n"),
                           F.col("up").alias("_up"), F.col("gained").alias("_gained"))
        # Only links that aren't past their root yet go on.
        longer = level.where("up is not null").join(
            far, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("up") == F.col("_n"))
        ).select("conv_id", "node", F.col("_up").alias("up"), (F.col("gained") + F.col("_gained")).alias("gained"))
        level = written(level.where("up is null").union(longer), "reply-links")
        levels.append(level)
        reach *= 2
    return levels


def paths(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """(conv_id, leaf, node, up): nodes of each conversation's ``best`` paths
    (None: all), ``up`` steps above the leaf.

    ``nodes`` has conv_id, node, parent and score.
    """
    levels = _links(nodes)
    parents = nodes.where("parent is not null").select(F.col("conv_id").alias("_c"), F.col("parent").alias("_n")).distinct()
    leaves = levels[-1].where("up is null").join(
        parents, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("node") == F.col("_n")), "left_anti")
    if best is not None:
        rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("gained"), "node"))
        leaves = leaves.withColumn("rank", rank).where(F.col("rank") <= best)
    found = leaves.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(levels) - 1)):
        step = levels[k].where("up is not null").select(
            F.col("conv_id").alias("_c"), F.col("node").alias("_n"), F.col("up").alias("_up"))
        further = found.join(step, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("node") == F.col("_n"))).select(
            "conv_id", "leaf", F.col("_up").alias("node"), (F.col("up") + 2 ** k).alias("up"))
        found = written(found.union(further), "reply-paths")
    return found


def format_paths(nodes: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row for each path: conv_id, leaf, formatted, loss (array of start
    and end in code points of ``formatted``)."""
    texts = nodes.select(F.col("conv_id").alias("_c"), F.col("node").alias("_n"), "role", "text")
    turn = F.struct(
        (-F.col("up")).alias("at"),
        (F.coalesce("role", F.lit("")) == LOSS_ROLE).alias("learnt"),
        escape(F.coalesce("role", F.lit("")), ROLE_ESCAPES).alias("role"),
        escape(F.coalesce("text", F.lit(""))).alias("text"))
    gathered = chosen.join(
        texts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("node") == F.col("_n"))
    ).groupBy("conv_id", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = "array<struct<start:int,end:int>>"
    fixed = len(OPEN + HEAD + MID)

    def add(so_far: Column, t: Column) -> Column:
        start = so_far["length"] + fixed + F.char_length(t["role"])
        end = start + F.char_length(t["text"])
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        return F.struct(
            (end + len(CLOSE)).alias("length"),
            F.when(t["learnt"], F.concat(so_far["loss"], F.array(span))).otherwise(so_far["loss"]).alias("loss"))

    line = F.transform("turns", lambda t: F.concat(
        F.lit(OPEN + HEAD), t["role"], F.lit(MID), t["text"], F.lit(CLOSE)))
    start = F.struct(F.lit(0).alias("length"), F.array().cast(spans).alias("loss"))
    return gathered.select(
        "conv_id", "leaf", F.array_join(line, "").alias("formatted"),
        F.aggregate("turns", start, add)["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with its turns (role, text) and the text under the loss mask."""
    pieces = F.split("formatted", CLOSE, -1)
    body = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, len(OPEN + HEAD) + 1, 2 ** 31 - 1))
    turns = F.transform(body, lambda b: F.struct(
        unescape(F.substring_index(b, MID, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(b, F.char_length(F.substring_index(b, MID, 1)) + len(MID) + 1)).alias("text")))
    loss = F.array_join(F.transform("loss", lambda s: unescape(
        F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    return formatted.select("*", turns.alias("turns"), loss.alias("loss_text"))


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    nodes = written(threads(rows), "reply-nodes")
    out = read_back(format_paths(nodes, paths(nodes)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), digest(told.cast("binary")).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        digest(F.col("loss_text").cast("binary")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


OP10_ORACLE = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized as (
  select *, length(role) + length(text) + 20
    + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), ':', ''))
    + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) as n
  from said)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from sized group by conv_id
"""
