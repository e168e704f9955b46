"""Table writes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every part file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def append_table(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """A table hashed and sorted by its key: later joins and guards on the key shuffle nothing.

    Rows go to their buckets before they are written, so every bucket is one file.  With ``path`` the
    files lie there and the catalogue holds the name alone.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
