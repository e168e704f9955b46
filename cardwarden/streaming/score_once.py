"""Scoring a stream so that an id is never scored twice."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators.predictions import new_keys_in, prediction_rows, transaction_rows
from cardwarden.operators.validation import accepted, rejected, with_reasons
from cardwarden.schemas import TRANSACTION
from cardwarden.streaming import jobs
from cardwarden.streaming.parse import parse_with_extras
from cardwarden.streaming.store import PredictionStore


def score_batch(store: PredictionStore, score: Callable[[DataFrame], DataFrame], model_name: str,
                model_version: str, earliest: list[Column], rejects_path: str,
                query: str | None = None) -> Callable[[DataFrame, int], None]:
    """A micro-batch handler: parse, validate, score unseen ids, write both tables.

    ``score`` adds fraud_probability, fraud_prediction, decision and threshold; it also sees the
    undeclared fields as the map ``extras``.  The stored latency is the batch's time per row.
    Rejected requests are written to ``rejects_path``.  ``query`` names the writer; in a stream it is
    the identity that Spark keeps with the checkpoint, so only a replayed batch is skipped.
    """
    def stored(ids: DataFrame) -> DataFrame:
        """The store's ids among these; only their buckets are opened."""
        return store.transactions(keys=ids.select(F.col(fixed.ID).alias("transaction_id"))).select(
            F.col("transaction_id").alias(fixed.ID))

    def run(records: DataFrame, batch_id: int) -> None:
        name = query or jobs.query_identity(records)
        if store.is_committed(name, batch_id):
            return
        # Parsed once, read for the rejects, the key lookup and the scoring.
        checked = with_reasons(parse_with_extras(records), TRANSACTION).drop("raw").persist()
        scored = None
        try:
            rejected(checked).select(
                *TRANSACTION.names, "topic", "partition", "offset", "reasons").write.mode("overwrite").parquet(
                f"{rejects_path}/query={name}/batch_id={batch_id}")
            fresh = new_keys_in(accepted(checked), stored, fixed.ID, earliest)
            scored = score(fresh).persist()
            start = time.perf_counter()
            rows = scored.count()
            per_row = (time.perf_counter() - start) * 1000 / max(rows, 1)
            timed = scored.withColumn("prediction_latency_ms", F.lit(per_row))
            now = F.current_timestamp()
            store.commit(transaction_rows(timed, now),
                         prediction_rows(timed, model_name, model_version, created_at=now), name, batch_id)
        finally:
            checked.unpersist()
            if scored is not None:
                scored.unpersist()
    return run
