"""Name -> (query, oracle SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, the same result in plain SQL."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round report columns so that summation order cannot show."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.round(c, p) for c, p in places.items()})
