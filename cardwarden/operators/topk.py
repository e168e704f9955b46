"""Top rows, top rows per group, seeded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden import fixed


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """Ordered by the full key, so equal values cannot change the result."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """The first n rows of every group.

    The rank filter lets Spark prune each task to n rows per group before the shuffle, so a group
    with a third of all rows arrives as n rows per task.
    """
    nth = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(rank, nth).where(F.col(rank) <= n)


def first_positive(df: DataFrame, target: str, key: str) -> DataFrame:
    """The positive row with the smallest key; an error when there is none."""
    row = df.where(F.col(target) == 1).orderBy(key).limit(1)
    if row.isEmpty():
        raise ValueError(f"no row with {target} = 1")
    return row


def sample_rows(df: DataFrame, key: str, n: int, seed: int = fixed.SEED) -> DataFrame:
    """A seeded sample of exactly min(n, rows) rows, the same for any partitioning."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(digest, key).limit(n)


def sample_one(df: DataFrame, key: str, seed: int = fixed.SEED) -> DataFrame:
    return sample_rows(df, key, 1, seed)
