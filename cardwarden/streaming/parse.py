"""Bus records to typed rows; works on streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden.functions.numeric import nan_to_null
from cardwarden.functions.once import once
from cardwarden.functions.text import decode, raw_fields, undeclared
from cardwarden.schemas import TRANSACTION, typed

POSITION = ["topic", "partition", "offset"]


def parse_records(records: DataFrame, schema: T.StructType = TRANSACTION, keep: list[str] = POSITION) -> DataFrame:
    """The declared fields of each JSON value plus the record's position on the bus.

    Fields are taken as text and cast one by one: whole numbers sent as ``13926.0`` (a bigint field
    would turn them into null) are truncated, and a field that cannot be read is null without
    costing the row its other fields.
    """
    wire = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    parsed = records.select(*keep, once(F.from_json(decode(F.col("value")), wire)).alias("t"))
    return nan_to_null(parsed.select(*[typed(F.col(f"t.`{f.name}`"), f).alias(f.name) for f in schema], *keep))


def parse_with_extras(records: DataFrame, schema: T.StructType = TRANSACTION,
                      keep: list[str] = POSITION) -> DataFrame:
    """As above, plus ``raw`` (every field as text) and ``extras`` (the undeclared ones)."""
    rows = records.select(*keep, once(raw_fields(decode(F.col("value")))).alias("raw"))
    fields = [typed(F.col("raw")[f.name], f).alias(f.name) for f in schema]
    return nan_to_null(rows.select(
        *fields, *keep, "raw", undeclared(F.col("raw"), schema.names).alias("extras")))
