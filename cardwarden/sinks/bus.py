"""Publishing rows to the message bus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.numeric import nan_to_null
from cardwarden.functions.text import compact_json


def as_messages(df: DataFrame, key: str = fixed.ID) -> DataFrame:
    """(key, value): the id as text and the whole row as one JSON object, absent values as null."""
    clean = nan_to_null(df)
    return clean.select(
        F.col(key).cast("string").alias("key"),
        compact_json(*[F.col(f"`{c}`") for c in df.columns]).alias("value"))


def publish(df: DataFrame, servers: str, topic: str, key: str = fixed.ID) -> None:
    """Every row once, acknowledged by all replicas."""
    as_messages(df, key).write.format("kafka").options(**{
        "kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "5",
    }).save()
