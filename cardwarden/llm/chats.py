"""Chat formatting after collapsing cumulative snapshots.

A logged conversation is a snapshot of a longer one when its turns are that one's first turns.  Every
turn gets a rolling hash of the conversation up to it; a conversation whose hash over all its turns
is among the proper prefixes' hashes is dropped by an anti-join, of equal ones the smallest id stays,
and what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.session import materialise

# Turns are numbered and hashed in blocks of the turn number, and rendered in parts of as many turns,
# so that a conversation of any length is never one task's.
BLOCK = 1024
# The markers of the rendered form.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _placed(turns: DataFrame) -> DataFrame:
    """conv, role, text and ``place``, the turn's number from 0 in the conversation.

    Places inside a block of turn numbers come from a window over that block, blocks are put one
    after the other by a running count; turns without number come first, ties go by role and text.
    """
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))).cast("bigint")
    rows = turns.withColumn("block", block)
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    running = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("conv", "block", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "block").orderBy("turn", "role", "text")
    return rows.withColumn("nth", F.row_number().over(inside) - 1).join(before, ["conv", "block"]).select(
        "conv", "role", "text", (F.col("before") + F.col("nth")).alias("place"))


SUMS = ["a", "b", "c", "d"]


def _prefixes(placed: DataFrame) -> DataFrame:
    """conv, place and four sums (``SUMS``) of the digests of all turns up to the place.

    Two digests of 64 bits cover the place, role and text, so equal sums mean equal turns in equal order;
    halves of digests are added, which cannot overflow, and make 128 bits together.
    """
    said = ["place", F.coalesce("role", F.lit("")), F.col("role").isNull(), F.coalesce("text", F.lit("")), F.col("text").isNull()]
    marks = [F.xxhash64(*said), F.xxhash64(F.lit("again"), *said)]
    halves = [half for m in marks for half in (m.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(m, 32))]
    rows = placed.select("conv", "place", (F.col("place") / BLOCK).cast("bigint").alias("block"),
                         *[h.alias(c) for h, c in zip(halves, SUMS)])
    inside = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "block").agg(*[F.sum(c).alias(c) for c in SUMS])
    before = sums.select("conv", "block", *[F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"before_{c}") for c in SUMS])
    return rows.select("conv", "block", "place", *[F.sum(c).over(inside).alias(f"in_{c}") for c in SUMS]).join(
        before, ["conv", "block"]).select(
        "conv", "place", *[(F.col(f"in_{c}") + F.col(f"before_{c}")).alias(c) for c in SUMS])


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(CLOSE + "\n"))


def maximal(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, part, n_turns, n_snapshots, chat): the maximal conversations, rendered.

    ``part`` counts from 0 in parts of BLOCK turns (one for nearly all), ``n_turns`` and ``n_snapshots``
    are the conversation's number of turns and of equal copies, itself included.  Null ids are one
    conversation.  Null turns come first, equal turn numbers by role and text; null roles and texts
    are rendered empty but differ from empty ones when compared.  Other columns are not read.
    """
    turns = conversations.select(*[F.col(f"`{c}`").alias(a) for c, a in
                                   ((conv, "id"), (turn, "turn"), (role, "role"), (text, "text"))])
    turns = turns.select(F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id")).alias("conv"),
                         "turn", "role", "text")
    placed = materialise(_placed(turns), "turns")
    prefixes = materialise(_prefixes(placed), "prefixes")
    sizes = placed.groupBy("conv").agg(F.max("place").alias("last"))
    ends = materialise(prefixes.join(sizes, "conv").where(F.col("place") == F.col("last")).select(
        "conv", "last", *SUMS), "ends")
    # One row per conversation: copies keep their smallest id, map-side.
    single = ends.groupBy("last", *SUMS).agg(F.min("conv").alias("conv"), F.count("*").alias("n_snapshots"))
    inner = prefixes.join(sizes, "conv").where(F.col("place") < F.col("last")).select(
        F.col("place").alias("last"), *SUMS).distinct()
    kept = materialise(single.join(inner, ["last", *SUMS], "left_anti"), "maximal")
    rows = placed.join(kept.select("conv", "last", "n_snapshots"), "conv").withColumn(
        "part", F.floor(F.col("place") / BLOCK))
    piece = F.struct("place", rendered(F.col("role"), F.col("text")).alias("line"))
    out = rows.groupBy("conv", "part", "last", "n_snapshots").agg(F.sort_array(F.collect_list(piece)).alias("lines"))
    return out.select(
        F.when(F.col("conv.none"), None).otherwise(F.col("conv.id")).alias(conv), "part",
        (F.col("last") + 1).alias("n_turns"), "n_snapshots",
        F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("chat"))
