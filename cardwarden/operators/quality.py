"""Table checks: keys, duplicates, ranges, value counts, audits.

The separate passes one would write by hand are fused: each report is one aggregate over one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions.numeric import percent
from cardwarden.schemas import leakage_names


def assert_frame(df: DataFrame, target: str | None = None) -> None:
    """Not empty, no repeated column names, no column that gives the target away."""
    names = [c.lower() for c in df.columns]
    repeated = sorted({c for c in names if names.count(c) > 1})
    if repeated:
        raise ValueError(f"repeated column names: {repeated}")
    if target is not None and leakage_names(df.columns, target):
        raise ValueError(f"columns named like the target: {leakage_names(df.columns, target)}")
    if df.isEmpty():
        raise ValueError("the table is empty")


def frame_report(df: DataFrame) -> DataFrame:
    """One row: rows, whether there are any, repeated column names, columns with any missing value."""
    names = [c.lower() for c in df.columns]
    repeated = sorted({c for c in names if names.count(c) > 1})
    places = [f"__{i}" for i in range(len(names))]  # repeated names can only be told apart by place
    missing = df.toDF(*places).agg(F.count("*").alias("total_rows"), *[F.count_if(F.col(p).isNull()).alias(p) for p in places])
    gappy = F.array_compact(F.array(*[F.when(F.col(p) > 0, F.lit(c)) for p, c in zip(places, df.columns)]))
    return missing.select("total_rows", (F.col("total_rows") == 0).alias("empty"),
                          F.array_join(F.array(*[F.lit(r) for r in repeated]).cast("array<string>"), ",").alias("repeated_names"),
                          F.array_join(gappy, ",").alias("missing_columns"))


def key_profile(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows, distinct keys and rows after the first of each key, exact over the whole table."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: str) -> None:
    """Eager key guard; stops at the first repeated key."""
    worst = duplicate_keys(df, key).limit(1).collect()
    if worst:
        raise ValueError(f"duplicate {key}: {worst[0][key]} occurs {worst[0]['n']} times")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct; copies collapse on the map side."""
    return df.distinct()


def removed_duplicates(df: DataFrame) -> DataFrame:
    """Row counts before and after dropping exact copies."""
    per_row = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("__n"))
    return per_row.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("removed"),
    )


def value_range(df: DataFrame, *columns: str) -> DataFrame:
    """Min and max of each column in one row."""
    return df.agg(*[
        e for c in columns for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))
    ])


def amount_profile(df: DataFrame, amount: str = fixed.AMOUNT) -> DataFrame:
    x = F.nanvl(F.col(amount), F.lit(None))
    return df.agg(
        F.min(x).alias("minimum"), F.max(x).alias("maximum"), F.avg(x).alias("mean"),
        F.count(x).alias("amounts"), F.count_if(x <= 0).alias("zero_or_negative"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share of each value."""
    total = df.agg(F.count(F.col(column))).scalar()
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.withColumn("percentage", F.col("n") / total * 100)


def _as_text(df: DataFrame, column: str) -> Column:
    col = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        col = F.nanvl(col + F.lit(0.0), F.lit(None))  # -0.0 is 0.0, NaN is missing
    return col.cast("string").alias(column)


def distinct_per_column(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, distinct_values), nulls not counted.

    Long form: a row per (column, value) after map-side merging.  Several ``countDistinct`` in one
    aggregate would make every expanded row as wide as the table.
    """
    columns = columns or df.columns
    text = df.select(*[_as_text(df, c) for c in columns])
    if len(columns) == 1:
        long = text.select(F.lit(columns[0]).alias("column"), F.col(f"`{columns[0]}`").alias("value"))
    else:
        long = text.unpivot([], [f"`{c}`" for c in columns], "column", "value")
    return long.distinct().groupBy("column").agg(F.count("value").alias("distinct_values"))


def high_cardinality(df: DataFrame, columns: list[str] | None = None,
                     limit: int = fixed.HIGH_CARDINALITY) -> DataFrame:
    return distinct_per_column(df, columns).where(F.col("distinct_values") > limit)


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of the left table the right table knows."""
    known = right.select(key).distinct().withColumn("__known", F.lit(1))
    return left.select(key).distinct().join(known, key, "left").agg(
        F.count("*").alias("total_keys"),
        F.count("__known").alias("matched_keys"),
        percent(F.count("__known"), F.count("*")).alias("coverage"),
    )


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of both tables; each side is reduced to distinct keys before they meet."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def orphan_keys(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; hot keys are merged before the join."""
    per_key = children.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = parents.select(F.col(parent_key).alias(key))
    return per_key.join(known, key, "left_anti")


def assert_no_orphans(children: DataFrame, key: str, parents: DataFrame, parent_key: str) -> None:
    bad = orphan_keys(children, key, parents, parent_key).limit(1).collect()
    if bad:
        raise ValueError(f"{key} {bad[0][key]} has no parent row")


def range_check(df: DataFrame, column: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Rows and rows outside [low, high]; a missing value is outside."""
    inside = F.coalesce(F.col(column).between(low, high), F.lit(False))
    return df.agg(F.count("*").alias("total_rows"), F.count_if(~inside).alias("out_of_range"))


def assert_result_columns(df: DataFrame, wanted: list[str]) -> None:
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"result lacks {absent}")


def golden_check(actual: DataFrame, expected: DataFrame, key: str, value: str,
                 tolerance: float) -> DataFrame:
    """Expected keys, keys found, and values further than the tolerance (or absent)."""
    want = expected.select(key, F.col(value).cast("double").alias("__want"))
    got = actual.select(key, F.col(value).cast("double").alias("__got"), F.lit(1).alias("__found"))
    close = F.coalesce(F.abs(F.col("__got") - F.col("__want")) <= tolerance, F.lit(False))
    return want.join(got, key, "left").agg(
        F.count("*").alias("expected_rows"), F.count("__found").alias("found"),
        F.count_if(~close).alias("mismatches"),
    )
