"""Schemas of the transaction message and the stored tables, and checks made on schemas alone."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed

LONG, DOUBLE, TEXT, FLAG, TIME = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampType()


def schema_of(**types: T.DataType) -> T.StructType:
    """Nullable columns in the given order."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# --- fixed values: fields of one transaction message -------------------------------------------
TRANSACTION = T.StructType([
    T.StructField("TransactionID", LONG),
    T.StructField("TransactionDT", LONG),
    T.StructField("TransactionAmt", DOUBLE),
    T.StructField("ProductCD", TEXT),
    T.StructField("card1", LONG),
    T.StructField("card2", DOUBLE),
    T.StructField("card3", DOUBLE),
    T.StructField("card4", TEXT),
    T.StructField("card5", DOUBLE),
    T.StructField("card6", TEXT),
    T.StructField("addr1", DOUBLE),
    T.StructField("addr2", DOUBLE),
    T.StructField("dist1", DOUBLE),
    T.StructField("dist2", DOUBLE),
    T.StructField("P_emaildomain", TEXT),
    T.StructField("R_emaildomain", TEXT),
    T.StructField("isFraud", LONG),
])
# --- fixed values: stored transactions, one row per id -------------------------------------------
STORED_TRANSACTION = T.StructType([
    T.StructField("transaction_id", LONG, False),
    T.StructField("transaction_dt", LONG, False),
    T.StructField("transaction_amt", T.DecimalType(18, 6), False),
    T.StructField("product_cd", TEXT),
    T.StructField("card1", LONG),
    T.StructField("card2", LONG),
    T.StructField("card3", LONG),
    T.StructField("card4", TEXT),
    T.StructField("card5", LONG),
    T.StructField("card6", TEXT),
    T.StructField("addr1", LONG),
    T.StructField("addr2", LONG),
    T.StructField("dist1", T.DecimalType(18, 6)),
    T.StructField("dist2", T.DecimalType(18, 6)),
    T.StructField("p_emaildomain", TEXT),
    T.StructField("r_emaildomain", TEXT),
    T.StructField("actual_fraud", FLAG),
    T.StructField("created_at", TIME, False),
])
# --- fixed values: prediction log, append only ---------------------------------------------------
STORED_PREDICTION = T.StructType([
    T.StructField("transaction_id", LONG, False),
    T.StructField("model_name", TEXT, False),
    T.StructField("model_version", TEXT, False),
    T.StructField("fraud_probability", T.DecimalType(12, 10), False),
    T.StructField("fraud_prediction", FLAG, False),
    T.StructField("decision", TEXT, False),
    T.StructField("threshold", T.DecimalType(5, 4), False),
    T.StructField("prediction_latency_ms", T.DecimalType(12, 4)),
    T.StructField("created_at", TIME, False),
])
# Columns of a record on the message bus.
BUS_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType()),
])


def typed(text: Column, field: T.StructField) -> Column:
    """A field sent as text in its declared type; null when it cannot be read."""
    if isinstance(field.dataType, T.LongType):
        # Digits enough to keep any fraction from rounding the whole number up.
        return text.try_cast(T.DecimalType(38, 18)).try_cast("bigint")
    return text.try_cast(field.dataType)


# --- feature lists -----------------------------------------------------------------------------

def feature_families(columns: list[str]) -> dict[str, list[str]]:
    """Columns of each family, in frame order; card, C, D … families match whole names."""
    return {
        family: [c for c in columns if re.fullmatch(pattern, c)]
        for family, pattern in fixed.FEATURE_FAMILIES
    }


def select_features(columns: list[str]) -> list[str]:
    """Family by family, each name once."""
    picked = [c for members in feature_families(columns).values() for c in members]
    return list(dict.fromkeys(picked))


def feature_group_counts(df: DataFrame, target: str = fixed.TARGET) -> DataFrame:
    """(group, n) per family plus what the selection leaves out."""
    families = feature_families(df.columns)
    chosen = select_features(df.columns)
    rows = [(name, len(members)) for name, members in families.items()]
    rows.append(("excluded", len([c for c in df.columns if c not in chosen and c != target])))
    return df.sparkSession.createDataFrame(rows, "group string, n int")


def all_features(columns: list[str], key: str = fixed.ID, target: str = fixed.TARGET) -> list[str]:
    return [c for c in columns if c not in (key, target)]


def numeric_and_categorical(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    """Split by declared type; a sample never decides a type here."""
    kinds = {f.name: f.dataType for f in df.schema}
    numeric = [c for c in columns if isinstance(kinds[c], T.NumericType)]
    return numeric, [c for c in columns if c not in numeric]


def leakage_names(columns: list[str], target: str = fixed.TARGET) -> list[str]:
    return [c for c in columns if c != target and c.lower() in fixed.LEAKAGE_NAMES]


def identifier_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if "id" in c.lower()]


# --- conformance -------------------------------------------------------------------------------

def conform(df: DataFrame, wanted: T.StructType, keep: list[str] = (), extras: str | None = None) -> DataFrame:
    """The wanted columns in the wanted order; an absent one becomes a typed null.

    ``extras`` names a map of undeclared fields as text to look absent ones up in.  One ``select``,
    so wide schemas do not grow the plan column by column.
    """
    have = set(df.columns)
    cols: list[Column] = [F.col(f"`{c}`") for c in keep]
    for field in wanted:
        if field.name in have:
            value = F.col(f"`{field.name}`").cast(field.dataType)
        elif extras:
            value = typed(F.col(extras)[field.name], field)
        else:
            value = F.lit(None).cast(field.dataType)
        cols.append(value.alias(field.name))
    return df.select(*cols)


def assert_same_columns(actual: list[str], wanted: list[str]) -> None:
    """Raise when columns are absent or undeclared."""
    absent = [c for c in wanted if c not in set(actual)]
    extra = [c for c in actual if c not in set(wanted)]
    if absent or extra:
        raise ValueError(f"schema mismatch: absent {absent}, undeclared {extra}")


def assert_numeric(df: DataFrame, columns: list[str]) -> None:
    """Model inputs must all be numbers."""
    text = numeric_and_categorical(df, columns)[1]
    if text:
        raise TypeError(f"not numeric: {text}")


def assert_feature_contract(names: list[str], originals: int = fixed.CONTRACT_FEATURES) -> None:
    """n originals and n indicators, each indicator belonging to an original."""
    flags = [n for n in names if n.endswith(fixed.MISSING_SUFFIX)]
    base = [n for n in names if not n.endswith(fixed.MISSING_SUFFIX)]
    if len(base) != originals or len(flags) != originals:
        raise ValueError(f"expected {originals} features and indicators, "
                         f"got {len(base)} and {len(flags)}")
    stray = {n.removesuffix(fixed.MISSING_SUFFIX) for n in flags} - set(base)
    if stray:
        raise ValueError(f"indicators without a feature: {sorted(stray)}")
