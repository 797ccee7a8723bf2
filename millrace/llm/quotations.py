"""Quotation linking: reply structure and own text of messages that quote each other.

Lines that begin with quote marks (``>``, nested ``>>`` or ``> >``) are parsed into levels. Every quoted line is normalised (lower case, single
spaces) and hashed, and meets the latest earlier message of the same conversation that has the line as its own. The message that
most lines of the outermost quotation (the lowest level that the message quotes at) come from is the one replied to; a message without linked quotation replies to the message before it.
Conversations come back in reply order (breadth first: by depth, then by time), without quotations and without their introductions.

Defined cases: a null text is an empty message; rows whose conversation or turn is null belong to no conversation and are left out; of rows that share
(conversation, turn) the one with the smallest (role, text) stands for all; a quoted line that no earlier message has is dropped without a link; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import ordered
from millrace.sources.session import cut_lineage

MARKS = r"^[\s>]*>"
#: Line ends that introduce a quotation in the languages of the corpus.
INTRODUCTION = r"(?i)(wrote|schrieb|a écrit|escribió)\s*:\s*$"
CHUNK = 512


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), r"\s", ""))


def body(line: Column) -> Column:
    return F.when(level(line) == 0, line).otherwise(F.regexp_replace(F.regexp_replace(line, MARKS, ""), "^ ", ""))


def normalised(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "))


def messages(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per (conversation, turn); repeated rows are settled by their smallest (role, text)."""
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.struct(F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")).alias("m"))
    rows = rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    return rows.groupBy("conv_id", "turn").agg(F.min("m").alias("m")).select("conv_id", "turn", "m.role", "m.text")


def parsed(msgs: DataFrame) -> DataFrame:
    """Adds ``lines``: level, body and whether the line introduces a quotation."""
    raw = F.split("text", "\n", -1)
    marked = F.transform(raw, lambda line: F.struct(level(line).alias("level"), body(line).alias("body"), F.coalesce(line.rlike(INTRODUCTION), F.lit(False)).alias("intro")))
    out = msgs.withColumn("marked", marked)
    follows = lambda i: F.coalesce(F.get("marked", i + 1)["level"] > F.get("marked", i)["level"], F.lit(False))
    lines = F.transform("marked", lambda x, i: F.struct(x["level"].alias("level"), x["body"].alias("body"), (x["intro"] & follows(i)).alias("intro")))
    return out.withColumn("lines", lines).drop("marked", "text")


def links(msgs: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked) for messages whose outermost quotation comes from an earlier message.

    Own and quoted lines lie on one time line per (conversation, line hash), so a quoted line meets one message and not all that share the line.
    The time line is windowed in chunks of turns: a conversation or line that holds a large share of the table is spread over tasks.
    """
    quoted = F.filter(F.transform("lines", lambda x: x["level"]), lambda n: n > 0)
    lines = msgs.select("conv_id", "turn", F.array_min(quoted).alias("outermost"), F.explode("lines").alias("x")).where(~F.col("x.intro"))
    # Where the author between has left nothing, the outermost quotation is a deeper one.
    lines = lines.where((F.col("x.level") == 0) | (F.col("x.level") == F.col("outermost")))
    lines = lines.select("conv_id", "turn", F.least("x.level", F.lit(1)).alias("level"), normalised(F.col("x.body")).alias("key")).where(F.col("key") != "")
    lines = lines.groupBy("conv_id", "turn", "level", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")).agg(F.count("*").alias("n"))
    line = lines.select("conv_id", "turn", "h1", "h2", "level", "n", F.when(F.col("level") == 0, F.col("turn")).alias("own"), (F.col("turn") * 2 + 1 - F.col("level")).alias("at"))
    filled = ordered.forward_fill(line, ["conv_id", "h1", "h2"], ["at"], "own", "source", chunk=F.floor(F.col("turn") / CHUNK))
    votes = filled.where((F.col("level") == 1) & F.col("source").isNotNull()).groupBy("conv_id", "turn", "source").agg(F.sum("n").alias("n"))
    best = votes.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "source")).alias("best"), F.sum("n").alias("n_linked"))
    return best.select("conv_id", "turn", F.col("best.source").alias("reply_to"), F.col("n_linked"))


def depths(edges: DataFrame) -> DataFrame:
    """Distance of every message from the start of its conversation. Pointer doubling: rounds grow with the logarithm of the longest chain, and only messages that have not arrived take part."""
    hops = F.when(F.col("reply_to").isNull(), 0).otherwise(1).cast("long")
    moving = cut_lineage(edges.select("conv_id", "turn", F.col("reply_to").alias("up"), hops.alias("depth")), "reply-depths")
    arrived = moving.where(F.col("up").isNull())
    moving = moving.where(F.col("up").isNotNull())
    while not moving.isEmpty():
        above = arrived.union(moving).select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next_up"), F.col("depth").alias("more"))
        moved = moving.join(above, ["conv_id", "up"]).select("conv_id", "turn", F.col("next_up").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        moved = cut_lineage(moved, "reply-depths")
        arrived = arrived.union(moved.where(F.col("up").isNull()))
        moving = moved.where(F.col("up").isNotNull())
    return arrived.select("conv_id", "turn", "depth")


def reply_ordered(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message: conv_id, turn, role, reply_to, depth, reply_pos (1, 2, ... in reply order), max_level, n_quoted, n_linked, own_text, formatted."""
    msgs = cut_lineage(parsed(messages(df, conv, turn, role, text)), "quoted-messages")
    found = links(msgs)
    # The message before, by the sorted turns of the conversation.
    before = ordered.lag_delta(msgs.select("conv_id", "turn"), ["conv_id"], ["turn"], {"previous": "turn"}, chunk=F.floor(F.col("turn") / CHUNK))
    edges = cut_lineage(before.join(found, ["conv_id", "turn"], "left").select("conv_id", "turn", F.coalesce("reply_to", "previous").alias("reply_to"), F.coalesce("n_linked", F.lit(0)).alias("n_linked")), "reply-edges")
    placed = edges.join(depths(edges), ["conv_id", "turn"])
    chunk = F.struct("depth", F.floor(F.col("turn") / CHUNK))
    numbered = ordered.sequence_number_in_group(placed, ["conv_id"], ["depth", "turn"], F.lit(True), "reply_pos", chunk=chunk)
    own = F.array_join(F.transform(F.filter("lines", lambda x: (x["level"] == 0) & ~x["intro"]), lambda x: x["body"]), "\n")
    texts = msgs.select("conv_id", "turn", "role", F.btrim(own, F.lit(" \t\r\n")).alias("own_text"), F.array_max(F.transform("lines", lambda x: x["level"])).alias("max_level"),
                        F.size(F.filter("lines", lambda x: x["level"] > 0)).alias("n_quoted"))
    out = numbered.join(texts, ["conv_id", "turn"])
    formatted = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("own_text"), F.lit("\n"))
    return out.select("conv_id", "turn", "role", "reply_to", "depth", F.col("reply_pos").cast("long").alias("reply_pos"), F.col("max_level").cast("long").alias("max_level"), F.col("n_quoted").cast("long").alias("n_quoted"),
                      F.col("n_linked").cast("long").alias("n_linked"), "own_text", formatted.alias("formatted"))
