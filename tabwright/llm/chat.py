"""Conversations from reply trees: root-to-leaf paths, ranked, each formatted for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.scratch import materialise

#: The template's control strings. Texts never hold ``<``, as it is escaped there.
TURN, END = "<|turn|>", "<|end|>\n"
#: Escapes, in the order in which they are applied. ``[`` is no control character here, but is one
#: of other templates; a line end would end a role.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsq;"), ("]", "&rsq;"))
ROLE_ESCAPES = (*ESCAPES, ("\n", "&nl;"))


def escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, coded in escapes:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, escapes=ESCAPES) -> Column:
    for plain, coded in reversed(escapes):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def chains(conversations: DataFrame) -> DataFrame:
    """Rows (``conv_id``, ``turn``, ``role``, ``text``) as reply trees in which each message answers
    the one before. Equal turns follow each other by role and text; null turns come first."""
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long")
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("msg_id", place)
            .select("conv_id", "msg_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1)
                    .alias("parent_id"), "role", "text", F.lit(0.0).alias("score")))


def tree_paths(messages: DataFrame) -> DataFrame:
    """Root-to-leaf paths of reply trees: ``tree``, ``leaf``, ``msg_id`` and ``up`` (steps from the
    leaf) for every message on a path.

    Self-joins double the steps: each round finds every message's ancestor twice as far up, until
    no message has one. Then the leaves walk up by these steps, the longest first, so paths of n
    messages take some 2 log2(n) joins, and rows are made for messages on paths only.
    """
    nodes = messages.select("tree", "msg_id", "parent_id")
    known = nodes.select("tree", F.col("msg_id").alias("parent_id"))
    jump = materialise(nodes.join(known.distinct(), ["tree", "parent_id"])
                       .select("tree", "msg_id", F.col("parent_id").alias("above")).distinct(),
                       "chat-jumps")
    parents = jump.select("tree", F.col("above").alias("msg_id")).distinct()
    jumps, most = [], messages.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("n")).first()[0] or 0
    while (1 << len(jumps)) < most and not jump.isEmpty():
        jumps.append(jump)
        further = jump.select("tree", F.col("msg_id").alias("above"),
                              F.col("above").alias("further"))
        jump = materialise(jump.join(further, ["tree", "above"])
                           .select("tree", "msg_id", F.col("further").alias("above")),
                           "chat-jumps")
    paths = materialise(nodes.join(parents, ["tree", "msg_id"], "left_anti").select(
        "tree", F.col("msg_id").alias("leaf"), "msg_id", F.lit(0).cast("long").alias("up"))
        .distinct(), "chat-paths")
    for k in reversed(range(len(jumps))):
        higher = (paths.join(jumps[k], ["tree", "msg_id"])
                  .select("tree", "leaf", F.col("above").alias("msg_id"),
                          (F.col("up") + (1 << k)).alias("up")))
        paths = materialise(paths.unionByName(higher), "chat-paths")
    return paths


def format_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Format the best paths of every reply tree as conversations.

    ``messages`` has ``conv_id``, ``msg_id`` (unique in its conversation), ``parent_id`` (null, or no
    message of the conversation: a root), ``role``, ``text`` and ``score``. Every root-to-leaf path
    is a branch; branches are ranked by the sum of their scores (then by leaf), and the first
    ``branches`` of each conversation are formatted (default: all).

    One row a branch: ``conv_id``, ``branch`` (rank from 1), ``score``, ``n_turns``, ``formatted`` and
    ``loss_spans``: start and length, in code points of ``formatted``, of each assistant text. A turn
    is ``<|turn|>role``, a line end, the text and ``<|end|>``; control characters inside roles and
    texts are escaped and :func:`read_back` restores them.

    Null roles and texts are empty, null scores 0, a null ``conv_id`` is a conversation like others;
    of messages with the same id one text for each copy is kept in order; messages in a circle
    have no leaf and form no branch; an empty table gives no rows; other columns are ignored.
    """
    rows = materialise(messages.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "msg_id",
        "parent_id", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "chat-messages")
    steps = tree_paths(rows).join(rows.drop("parent_id"), ["tree", "msg_id"])
    ranked = (steps.groupBy("tree", "leaf").agg(F.sum("score").alias("path_score"))
              .withColumn("branch", F.row_number().over(
                  Window.partitionBy("tree").orderBy(F.desc("path_score"), "leaf"))))
    if branches is not None:
        ranked = ranked.where(F.col("branch") <= branches)
    body = F.concat(F.lit(TURN), escape(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    turns = (steps.join(ranked, ["tree", "leaf"])
             .withColumn("head", body).withColumn("body", escape(F.col("text")))
             .withColumn("piece", F.concat("head", "body", F.lit(END))))
    before = (Window.partitionBy("tree", "leaf").orderBy(F.desc("up"), "role", "text")
              .rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before),
                                                 F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct(
        "start", F.length("body").cast("long").alias("length")))
    return (turns.groupBy("tree", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("branch").alias("branch"),
        F.first("path_score").alias("score"), F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))
        .select("conv_id", "branch", "score", "n_turns",
                F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss_spans"))


def read_back(formatted: Column) -> Column:
    """Turns (``role``, ``text``) of a formatted conversation, unescaped."""
    parts = F.split(formatted, "<\\|turn\\|>")
    bodies = F.transform(F.slice(parts, F.lit(2), F.size(parts)),
                         lambda part: F.substring_index(part, "<", 1))
    return F.transform(bodies, lambda b: F.struct(
        unescape(F.substring_index(b, "\n", 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(b, F.instr(b, "\n") + 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(
        spans, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"),
                                  s["length"].cast("int"))), ""))
