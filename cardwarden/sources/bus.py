"""The message bus as a streaming or batch source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.schemas import BUS_RECORD


def bus_options(servers: str, topic: str, per_trigger: int | None = None, **extra) -> dict[str, str]:
    """Start at the earliest record, go on when old offsets are gone; bound each micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": "earliest", "failOnDataLoss": "false"}
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options | {k.replace("__", "."): str(v) for k, v in extra.items()}


def bus_stream(spark: SparkSession, servers: str, topic: str, **extra) -> DataFrame:
    """Records as they arrive; offsets live in the query's checkpoint, not in a consumer group."""
    return spark.readStream.format("kafka").options(**bus_options(servers, topic, **extra)).load()


def bus_table(spark: SparkSession, servers: str, topic: str, **extra) -> DataFrame:
    """The same records as a bounded table, for replays."""
    return spark.read.format("kafka").options(**bus_options(servers, topic, **extra)).load()


def captured_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Bus-shaped records captured as Parquet files."""
    return spark.readStream.schema(BUS_RECORD).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
