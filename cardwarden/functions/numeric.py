"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is the missing marker of float columns at the edge; past it only null means missing."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*[
        F.nanvl(F.col(f"`{c}`"), F.lit(None)).alias(c) if c in floats else F.col(f"`{c}`")
        for c in df.columns
    ])


def exact_decimal(value: Column, precision: int, scale: int) -> Column:
    """Decimal of the printed number, not of its binary expansion."""
    return value.cast("string").cast(T.DecimalType(precision, scale))


def whole(value: Column) -> Column:
    """Truncate toward zero; null stays null."""
    return value.cast("bigint")


def half_even(value: Column, places: int = 4) -> Column:
    return F.bround(value, places)


def ratio(part: Column, whole_: Column, empty: float | None = 0.0) -> Column:
    """part / whole, with ``empty`` where the whole is zero."""
    return F.when(whole_ != 0, part / whole_).otherwise(F.lit(empty).cast("double"))


def percent(part: Column, whole_: Column) -> Column:
    return ratio(part * 100.0, whole_)


def missing_flag(name: str) -> Column:
    return F.col(f"`{name}`").isNull().cast("tinyint")


def missing_count(names: list[str]) -> Column:
    """How many of the columns are null in this row.

    A filtered array of booleans: a sum of hundreds of terms would not fit one compiled method.
    """
    flags = F.array(*[F.col(f"`{c}`").isNull() for c in names])
    return F.size(F.filter(flags, lambda missing: missing))
