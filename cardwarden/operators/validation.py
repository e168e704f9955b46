"""Row validation with reasons for incoming requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions.once import once

REQUIRED = [fixed.ID, fixed.TIME, fixed.AMOUNT]


def checks(raw: str, schema: T.StructType, required: list[str] = REQUIRED) -> Column:
    """One entry per possible fault, null where the row does not have it.

    ``missing:<field>`` for an absent required field, ``type:<field>`` for an unreadable one.
    """
    found = []
    for field in schema:
        sent = F.col(raw)[field.name].isNotNull()
        read = F.col(f"`{field.name}`").isNotNull()
        found.append(F.when(sent & ~read, F.lit(f"type:{field.name}")))
        if field.name in required:
            found.append(F.when(~sent, F.lit(f"missing:{field.name}")))
    return F.array(*found)


def with_reasons(parsed: DataFrame, schema: T.StructType, raw: str = "raw",
                 required: list[str] = REQUIRED) -> DataFrame:
    """Adds ``reasons``; parsing never drops a row, so rejected ones can be reported."""
    checked = parsed.select("*", once(checks(raw, schema, required)).alias("__checks"))
    return checked.select(*[F.col(f"`{c}`") for c in parsed.columns], F.array_compact("__checks").alias("reasons"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)
