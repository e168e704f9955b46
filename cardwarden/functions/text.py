"""Text and JSON column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed

RAW_MAP = T.MapType(T.StringType(), T.StringType())


def store_key(key: Column) -> Column:
    return F.concat(F.lit(fixed.STORE_KEY_PREFIX), key.cast("string"))


def compact_json(*cols: str | Column) -> Column:
    """Compact JSON of the columns; absent values stay as ``null``."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def decode(binary: Column) -> Column:
    return binary.cast("string")


def raw_fields(text: Column) -> Column:
    """Every top-level JSON field as text, declared or not."""
    return F.from_json(text, RAW_MAP)


def undeclared(raw: Column, declared: list[str]) -> Column:
    """The fields a schema does not name."""
    return F.map_filter(raw, lambda k, _: ~k.isin(*declared))


def contains_ignoring_case(text: Column, part: str) -> Column:
    return F.lower(text).contains(part.lower())


def id_matches(key: Column, pattern: str) -> Column:
    """Search a numeric id by a pattern in its printed form."""
    return key.cast("string").rlike(pattern)
