"""Stored transactions and the append-only prediction log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions.numeric import exact_decimal, whole
from cardwarden.operators.joins import known_subset, spread_join
from cardwarden.operators.ordering import first_by
from cardwarden.schemas import STORED_TRANSACTION
from cardwarden.session import materialise


# Stored name and name in the request.
SENT_AS = [
    ("transaction_id", "TransactionID"), ("transaction_dt", "TransactionDT"), ("transaction_amt", "TransactionAmt"),
    ("product_cd", "ProductCD"), ("card1", "card1"), ("card2", "card2"), ("card3", "card3"), ("card4", "card4"),
    ("card5", "card5"), ("card6", "card6"), ("addr1", "addr1"), ("addr2", "addr2"), ("dist1", "dist1"), ("dist2", "dist2"),
    ("p_emaildomain", "P_emaildomain"), ("r_emaildomain", "R_emaildomain"),
]


def transaction_rows(scored: DataFrame, created_at: Column | None = None) -> DataFrame:
    """Requests in the types of the transaction table; labels are unknown when scoring."""
    def stored(sent: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.DecimalType):
            return exact_decimal(F.col(sent), kind.precision, kind.scale)
        return whole(F.col(sent)) if isinstance(kind, T.LongType) else F.col(sent)

    return scored.select(
        *[stored(sent, STORED_TRANSACTION[name].dataType).alias(name) for name, sent in SENT_AS],
        F.lit(None).cast("boolean").alias("actual_fraud"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"))


def prediction_rows(scored: DataFrame, model_name: str, model_version: str, key: str = fixed.ID,
                    created_at: Column | None = None) -> DataFrame:
    """Score columns in the types of the prediction log."""
    return scored.select(
        whole(F.col(key)).alias("transaction_id"),
        F.lit(model_name).alias("model_name"), F.lit(model_version).alias("model_version"),
        exact_decimal(F.col("fraud_probability"), 12, 10).alias("fraud_probability"),
        F.col("fraud_prediction"), F.col("decision"),
        exact_decimal(F.col("threshold"), 5, 4).alias("threshold"),
        exact_decimal(F.col("prediction_latency_ms"), 12, 4).alias("prediction_latency_ms"),
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


def latest_per_key(log: DataFrame, key: str, newest: list[Column]) -> DataFrame:
    """The newest row of every key."""
    return first_by(log, key, newest, latest=True)


def recent(log: DataFrame, newest: list[Column], n: int = 20) -> DataFrame:
    return log.orderBy(*newest).limit(n)


def new_keys(batch: DataFrame, existing: DataFrame, key: str, earliest: list[Column]) -> DataFrame:
    """First row of each batch key that the table does not hold yet.

    The batch is reduced to one row per key before anything is joined, and the table is first cut
    to the batch's keys, so a busy key and a large table cost one narrow pass each.
    """
    firsts = materialise(first_by(batch, key, earliest), "firsts")
    stored = known_subset(existing.select(key), firsts.select(key), key).distinct()
    return firsts.join(stored, key, "left_anti")


def new_keys_in(batch: DataFrame, stored: Callable[[DataFrame], DataFrame], key: str, earliest: list[Column]) -> DataFrame:
    """As ``new_keys`` over an indexed table: ``stored`` gives the table's rows of the asked keys."""
    firsts = materialise(first_by(batch, key, earliest), "firsts")
    return firsts.join(stored(firsts.select(key)).select(key).distinct(), key, "left_anti")


def score_once(requests: DataFrame, log: DataFrame, key: str, earliest: list[Column],
               newest: list[Column], score) -> DataFrame:
    """One result per requested id: the newest stored one, else a new score of its first request.

    A stored result is returned whatever its age; only unseen ids are scored.  ``score`` maps the
    unseen requests to the columns of the log.
    """
    firsts = materialise(first_by(requests, key, earliest), "firsts")
    mine = known_subset(log, firsts.select(key), key)
    stored = latest_per_key(mine, key, newest)
    unseen = firsts.join(stored.select(key), key, "left_anti")
    names = [c for c in log.columns]
    return stored.select(*names, F.lit("stored").alias("source")).unionByName(
        score(unseen).select(*names, F.lit("model").alias("source")))


def attach_results(requests: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Every request with its id's result, results being unique per id; hot ids are spread."""
    return spread_join(requests, results, key)


def delete_cascade(transactions: DataFrame, predictions: DataFrame, keys: DataFrame,
                   key: str = "transaction_id") -> tuple[DataFrame, DataFrame]:
    """Both tables without the given ids, as frames; ``PredictionStore.delete`` does it to stored tables."""
    gone = keys.select(key).distinct()
    return (transactions.join(gone, key, "left_anti"), predictions.join(gone, key, "left_anti"))


# --- stored results with a lifetime ---------------------------------------------------------------

def with_expiry(entries: DataFrame, created_at: str = "created_at",
                ttl_seconds: int = fixed.STORE_TTL_SECONDS) -> DataFrame:
    if ttl_seconds <= 0:
        raise ValueError("the lifetime must be greater than zero")
    return entries.withColumn(
        "expires_at", F.col(created_at) + F.make_interval(secs=F.lit(ttl_seconds)))


def live_entries(entries: DataFrame, now: Column) -> DataFrame:
    """Entries that still answer a lookup, with the seconds they have left."""
    left = F.timestamp_diff("MICROSECOND", now, F.col("expires_at")) / 1e6
    return entries.where(now < F.col("expires_at")).withColumn("remaining_seconds", left)


def drop_entries(entries: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return entries.join(keys.select(key).distinct(), key, "left_anti")
