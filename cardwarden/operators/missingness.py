"""Missing-value structure and its relation to the target."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.numeric import missing_count, missing_flag, ratio
from cardwarden.operators.ordering import exact_quantiles

# Columns per aggregate: beyond this whole-stage code generation gives up on the row width.
BLOCK = 100
MOMENTS = ["count", "mean", "std", "min", "max"]


def add_indicators(df: DataFrame, columns: list[str]) -> DataFrame:
    """``<column>_missing`` in one projection."""
    return df.select(
        "*", *[missing_flag(c).alias(c + fixed.MISSING_SUFFIX) for c in columns])


def _per_column(df: DataFrame, columns: list[str], measures) -> DataFrame:
    """One row per column; ``measures(column)`` gives named aggregates.

    Blocks of columns, each a pruned scan with a single aggregated row turned to long form.
    """
    parts = []
    for at in range(0, len(columns), BLOCK):
        block = columns[at:at + BLOCK]
        aggs, structs = [], []
        for i, c in enumerate(block, start=at):
            fields: list[Column] = [F.lit(c).alias("column")]
            for name, agg in measures(c).items():
                aggs.append(agg.alias(f"m{i}_{name}"))
                fields.append(F.col(f"m{i}_{name}").alias(name))
            structs.append(F.struct(*fields))
        parts.append(df.agg(*aggs).select(F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, parts)


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, missing_count, missing_percentage) of every column."""
    return _per_column(df, columns or df.columns, lambda c: {
        "missing_count": F.count_if(F.col(f"`{c}`").isNull()),
        "missing_percentage": F.coalesce(F.avg(missing_flag(c)) * 100, F.lit(0.0)),
    })


def most_missing(df: DataFrame, columns: list[str] | None = None, n: int = 30) -> DataFrame:
    return missing_profile(df, columns).orderBy(F.desc("missing_percentage"), "column").limit(n)


def rate_by_bucket(df: DataFrame, bucket: Column, target: str, name: str = "missing_count",
                   min_rows: int = fixed.MIN_GROUP_ROWS) -> DataFrame:
    """Rows, positives and rate per bucket, for buckets with enough labelled rows."""
    y = F.col(target)
    return (
        df.groupBy(bucket.alias(name))
        .agg(F.count(y).alias("transactions"), F.sum(y).cast("bigint").alias("fraud_count"),
             F.avg(y).alias("fraud_rate"))
        .where(F.col("transactions") >= min_rows)
    )


def rate_by_missing_count(df: DataFrame, columns: list[str], target: str,
                          min_rows: int = fixed.MIN_GROUP_ROWS,
                          name: str = "missing_count") -> DataFrame:
    return rate_by_bucket(df, missing_count(columns), target, name, min_rows)


def rate_missing_vs_present(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Per column: missing count and share, target rate on either side (0 for an empty side)."""
    y = F.col(target)

    def measures(c: str) -> dict[str, Column]:
        gone = F.col(f"`{c}`").isNull()
        return {
            "missing_count": F.count_if(gone),
            "missing_percentage": ratio(F.count_if(gone) * 100.0, F.count("*")),
            "rate_missing": F.coalesce(F.avg(F.when(gone, y)), F.lit(0.0)),
            "rate_present": F.coalesce(F.avg(F.when(~gone, y)), F.lit(0.0)),
        }

    return _per_column(df, columns, measures)


def describe(df: DataFrame, columns: list[str], probs: list[float] = fixed.DESCRIBE_PROBS) -> DataFrame:
    """count, mean, std, min, exact interpolated percentiles and max of number columns."""
    def measures(c: str) -> dict[str, Column]:
        x = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
        return {"count": F.count(x), "mean": F.avg(x), "std": F.stddev_samp(x),
                "min": F.min(x), "max": F.max(x)}

    # One row per column reaches the driver; it also bounds the search for the percentiles.
    moments = {r["column"]: r for r in _per_column(df, columns, measures).collect()}
    bounds = {c: (r["count"], r["min"], r["max"]) for c, r in moments.items() if r["count"]}
    points = exact_quantiles(df, columns, probs, bounds)
    rows = [(c, *[moments[c][m] for m in MOMENTS], *points[c]) for c in columns]
    names = [f"p{round(p * 100):02d}" for p in probs]
    fields = ["column string", "count bigint", *[f"{n} double" for n in [*MOMENTS[1:], *names]]]
    return df.sparkSession.createDataFrame(rows, ", ".join(fields))
