"""Mixing sources to target weights by entropy balancing.

The rates nearest to one copy of every document, in relative entropy, under a token constraint per
source and at most ``MOST`` copies, are w = min(MOST, exp(lambda x)): x is the document's size over
its source's mean and lambda the source's dual variable.  The convex dual is solved for all sources
at once by guarded Newton steps over cells (source, size), which the documents are counted into
beforehand; then the rates are rounded into whole copies so that each source's words come out near
its target.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.common import word_count
from cardwarden.operators.ordering import dense_codes
from cardwarden.session import materialise

WEIGHTS = (5, 2, 1)
MOST = 3
TOLERANCE = 1e-7
MAX_STEPS = 200
# Sizes are cells of their own up to here, and 512 cells per doubling beyond: a source has a bounded
# number of cells whatever its number of documents.
EXACT_SIZES = 4096
CELLS_PER_DOUBLING = 512
# Cells with more documents than this and than 1 / HEAVY_CELLS of all are dealt out in parts.
PART_ROWS = 256
HEAVY_CELLS = 4096


def _cell(size: Column) -> Column:
    far = EXACT_SIZES + F.floor(F.log2(size / EXACT_SIZES) * CELLS_PER_DOUBLING)
    return F.when(size < EXACT_SIZES, size).otherwise(far).cast("int")


def _weights(place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (__src, source_size) with ``target``: shares by weight, stopped at MOST times the size.

    Capped sources give up their excess, shared again by weight among the others, until none is above;
    one number per round comes to the driver.  Every round caps at least one more source or is the last.
    """
    ranked = materialise(
        sources.join(dense_codes(sources.select("__src"), "__src"), "__src").withColumn("__w", _weights(F.col("code"))),
        "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    cap, level, capped = MOST * F.col("source_size"), None, -1
    while True:
        held = F.lit(False) if level is None else F.col("__w") * level > cap
        s = ranked.agg(F.count_if(held).alias("n"), F.sum(F.when(held, cap).otherwise(0)).alias("cap"),
                       F.sum(F.when(held, 0.0).otherwise(F.col("__w"))).alias("w")).first()
        if not s.w or s.n == capped:
            break
        capped, level = s.n, (total - s.cap) / s.w
    return ranked.select("__src", "source_size", F.least(F.col("__w") * (level or 0.0), cap.cast("double")).alias("target"))


def solve(cells: DataFrame, sources: DataFrame) -> DataFrame:
    """(__src, lam) solving sum over a source's cells of tokens * min(MOST, exp(lam x)) = target.

    Newton steps run for all sources in one aggregate over the cells; a step that leaves its bracket
    becomes a bisection, so every source settles.  Each step is a stored table of one row per source.
    """
    x = (F.col("tokens") / F.col("docs")) / F.col("mean")
    state = materialise(
        cells.where("tokens > 0").groupBy("__src").agg(
            (F.sum("tokens") / F.sum("docs")).alias("mean"), F.min(F.col("tokens") / F.col("docs")).alias("least"))
        .join(sources, "__src").select(
            "__src", "mean", "target", "source_size", F.log(F.col("target") / F.col("source_size")).alias("__log"),
            (F.col("least") / F.col("mean")).alias("__x"))
        .select("__src", "mean", "target",
                F.least(F.lit(0.0), F.col("__log") / F.col("__x")).alias("lo"),
                (math.log(MOST) / F.col("__x")).alias("hi"),
                # A source at its cap takes everything as often as allowed.
                F.when(F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12), math.log(MOST) / F.col("__x"))
                .otherwise(0.0).alias("lam"), F.lit(1.0).alias("off")), "dual")
    lam, lo, hi = F.col("lam"), F.col("lo"), F.col("hi")
    for _ in range(MAX_STEPS):
        w = F.least(F.lit(float(MOST)), F.exp(lam * x))
        sums = cells.where("tokens > 0").join(state.select("__src", "lam", "mean"), "__src").groupBy("__src").agg(
            F.sum(F.col("tokens") * w).alias("f"),
            F.sum(F.when(w < MOST, F.col("tokens") * x * w).otherwise(0.0)).alias("slope"))
        gap = F.col("f") - F.col("target")
        low, high = F.when(gap < 0, lam).otherwise(lo), F.when(gap > 0, lam).otherwise(hi)
        step = lam - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (step > low) & (step < high)
        settled = F.abs(gap) <= TOLERANCE * F.col("target")
        state = materialise(state.join(sums, "__src").select(
            "__src", "mean", "target", low.alias("lo"), high.alias("hi"),
            F.when(settled, lam).when(inside, step).otherwise((low + high) / 2).alias("lam"),
            (F.abs(gap) / F.col("target")).alias("off")), "dual")
        if (state.agg(F.max("off")).first()[0] or 0.0) <= TOLERANCE:
            return state
    raise RuntimeError("entropy balancing did not settle")


def _round_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for one source's cells, largest sizes first: what rounding leaves over or takes too
    much is carried to the next cell, so the source ends within half of its smallest documents.  A cell
    may give or take up to one copy per document for that."""
    rows = rows.sort_values("__cell", ascending=False)
    whole, extras, carry = [], [], 0.0
    for docs, tokens, rate in zip(rows["docs"], rows["tokens"], rows["rate"]):
        size = tokens / docs
        copies = 0
        if size:
            want = docs * rate + carry / size
            least, most = max(0, math.floor(rate) - 1) * docs, min(MOST, math.ceil(rate) + 1) * docs
            copies = min(max(round(want), least), most)
            carry = (want - copies) * size
        whole.append(copies // docs)
        extras.append(copies % docs)
    return rows.assign(whole=whole, extra=extras)


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          carry: bool = False) -> DataFrame:
    """Every row with its size, source_size, target, taken, copies and rate.

    With ``carry`` the columns of ``docs`` come along (those named like a result are replaced),
    otherwise only the key.  Sizes are words, a null text has none; a row without words is never
    taken.  Null sources are one source, placed last.  Repeated rows count each.  Rerunning gives
    the same copies: documents are picked within a cell by a digest of their key, ties by row.
    """
    result = ["size", "source_size", "target", "taken", "copies", "rate"]
    own = [c for c in docs.columns if c not in result] if carry else [key]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in own], word_count(F.col(f"`{text}`")).alias("size"),
        F.when(F.col(f"`{source}`").isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(f"`{source}`"))).alias("__src"))
    if not carry:
        rows = materialise(rows, "sizes")
    rows = rows.withColumn("__cell", _cell(F.col("size")))
    cells = materialise(rows.groupBy("__src", "__cell").agg(
        F.count("*").alias("docs"), F.sum("size").alias("tokens")), "cells")
    sources = materialise(targets(cells.groupBy("__src").agg(F.sum("tokens").alias("source_size"))), "targets")
    dual = solve(cells, sources)

    x = (F.col("tokens") / F.col("docs")) / F.col("mean")
    rate = F.when(F.col("tokens") > 0, F.least(F.lit(float(MOST)), F.exp(F.col("lam") * x))).otherwise(0.0)
    rated = cells.join(dual.select("__src", "mean", "lam"), "__src", "left").select(
        "__src", "__cell", "docs", "tokens", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    rounded = materialise(rated.groupBy("__src").applyInPandas(
        _round_cells, "__src string, __cell int, docs bigint, tokens bigint, rate double, whole bigint, extra bigint"), "rounded")

    # Fewer than HEAVY_CELLS rows, whatever the input: each has more than that part of all documents.
    total = cells.agg(F.sum("docs")).first()[0] or 0
    part_rows = max(PART_ROWS, total // HEAVY_CELLS)
    heavy = F.broadcast(rounded.where(F.col("docs") > part_rows).select(
        "__src", "__cell", F.ceil(F.col("docs") / part_rows).cast("int").alias("__parts")))
    mark = F.xxhash64(F.col(f"`{key}`"), F.lit(1))
    dealt = rows.join(heavy, ["__src", "__cell"], "left").withColumn(
        "__part", F.coalesce(F.pmod(mark, F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    before = Window.partitionBy("__src", "__cell").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("__src", "__cell", "__part").agg(F.count("*").alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    facts = materialise(parts.join(rounded, ["__src", "__cell"]).join(sources, "__src").select(
        "__src", "__cell", "__part", "source_size", "target", "rate", F.col("whole").alias("__whole"),
        F.greatest(F.lit(0), F.least(F.col("__n"), F.col("extra") - F.col("__before"))).alias("__quota")), "parts")
    nth = F.row_number().over(Window.partitionBy("__src", "__cell", "__part").orderBy(
        F.xxhash64(F.col(f"`{key}`")), *[F.col(f"`{c}`") for c in own if c == key], "size"))
    picked = dealt.join(facts, ["__src", "__cell", "__part"]).withColumn(
        "copies", (F.col("__whole") + (nth <= F.col("__quota")).cast("int")).cast("bigint"))
    return picked.select(
        *[F.col(f"`{c}`") for c in own], "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")
