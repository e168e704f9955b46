"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.session import materialise

MAX_ROUNDS = 60


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest one it knows."""
    both = _both(edges)
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.union(least.select(F.col("m").alias("a"), "b"))


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).distinct()


def _digest(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftrightunsigned(mark, 32)), F.sum(mark.bitwiseAND(0xFFFFFFFF))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node reached.

    Both aggregates combine before the shuffle, and the joins are plain equi-joins whose skewed
    partitions Spark splits, so a node linked to a third of all others is no bottleneck.  Each round
    is a stored table.  Self loops and repeated edges do no harm; edges with a null are left out.
    """
    known = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("a").isNull().alias("x"),
                         F.col("b").isNull().alias("y")).where("not x and not y").select("a", "b")
    now = materialise(_clean(known), "edges")
    seen = _digest(now)
    for _ in range(MAX_ROUNDS):
        now = materialise(_clean(_small_star(_clean(_large_star(now)))), "edges")
        mark = _digest(now)
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())
