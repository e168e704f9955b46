"""How far a distribution moved between two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A share of nothing counts as this, so that an empty bin has a finite index.
LEAST_SHARE = 1e-4


def bin_of(value: Column, bounds: list[float]) -> Column:
    """Number of the fixed bin: how many bounds the value reaches; -1 for a missing value."""
    reached = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b <= value))
    return F.when(value.isNull(), -1).otherwise(reached)


def population_stability(df: DataFrame, value: str, bounds: list[float], later: Column) -> DataFrame:
    """Per bin the shares of the earlier and later rows and their part of the stability index.

    One aggregate of as many rows as bins; missing values are a bin of their own, and bins that
    neither side fills are left out.
    """
    counts = df.groupBy(bin_of(F.col(value), bounds).alias("bin")).agg(
        F.count_if(~later).alias("before"), F.count_if(later).alias("after"))
    totals = df.agg(F.count_if(~later).alias("n"), F.count_if(later).alias("m"))
    # One row.
    shares = counts.join(F.broadcast(totals)).select(
        "bin", "before", "after", F.greatest(F.try_divide("before", "n"), F.lit(LEAST_SHARE)).alias("p"),
        F.greatest(F.try_divide("after", "m"), F.lit(LEAST_SHARE)).alias("q"))
    return shares.select("bin", "before", "after", ((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))
