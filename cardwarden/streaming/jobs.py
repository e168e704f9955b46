"""Starting queries.  Every query has a checkpoint; restarts resume from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_console(rows: DataFrame, checkpoint: str) -> StreamingQuery:
    """Print arriving rows untruncated, twenty per batch."""
    return rows.writeStream.format("console").outputMode("append").options(
        truncate="false", numRows="20", checkpointLocation=checkpoint).start()


def to_files(rows: DataFrame, path: str, checkpoint: str, available_only: bool = False) -> StreamingQuery:
    """Append Parquet files; each row lands exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(availableNow=True) if available_only else writer).start()


def each_batch(rows: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str,
               available_only: bool = False) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_only else writer).start()


def query_identity(batch: DataFrame) -> str:
    """The identity of the query whose micro-batch this is; it lives in the checkpoint and outlasts restarts."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("outside a running stream the writer's name must be given")
    return found


def to_latest_windows(counts: DataFrame, path: str, checkpoint: str, available_only: bool = False) -> StreamingQuery:
    """Windowed counts in update mode: every batch stores the windows it changed, open ones included.

    Batches are kept by query identity: a new checkpoint counts from 0 beside the old one's windows.
    """
    def run(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/query={query_identity(changed)}/batch_id={batch_id}")

    writer = counts.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_only else writer).start()


def latest_windows(stored: DataFrame, by: list[str], count: str = "events") -> DataFrame:
    """Each window as each query's last batch left it; queries read different rows, so theirs add up."""
    last = stored.groupBy(*by, "query").agg(F.max_by(count, "batch_id").alias(count))
    return last.groupBy(*by).agg(F.sum(count).alias(count))


def finish(query: StreamingQuery) -> None:
    """Wait for a bounded query; its failure is the caller's failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def windowed_counts(rows: DataFrame, time: str, by: list[str], every: str = "1 minute",
                    late_by: str | None = "10 minutes") -> DataFrame:
    """Counts per window and label; state is kept only for windows the watermark has not closed.

    For a bounded table, whose files come in any order, ``late_by`` is None: no window closes, no row
    is late, and the state is as large as the result.
    """
    clock = rows.withColumn(time, F.col(time).cast("timestamp"))
    clock = clock if late_by is None else clock.withWatermark(time, late_by)
    return clock.groupBy(F.window(time, every).alias("w"), *by).agg(
        F.count("*").alias("events")).select(F.col("w.start").alias("minute"), *by, "events")


def span_of(rows: DataFrame, time: str, least_days: int) -> str:
    """A horizon that holds all rows of a bounded table, whatever their order; at least so many days."""
    at = F.col(time).cast("timestamp").cast("double")
    seconds = rows.agg((F.ceil(F.max(at) - F.min(at)) + 1).alias("s")).first().s or 0
    return f"{max(int(seconds), least_days * 86_400)} seconds"


def dedupe_within(rows: DataFrame, key: str, time: str, horizon: str) -> DataFrame:
    """First row per key, remembered for the horizon: the form with bounded state.

    Ids older than the horizon are forgotten; where a second score must never happen use the log.
    """
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(
        time, horizon).dropDuplicatesWithinWatermark([key])
