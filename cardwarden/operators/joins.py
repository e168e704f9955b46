"""Joins under key guarantees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.numeric import percent
from cardwarden.session import BROADCAST_ROWS, materialise

PRESENT = "__present"


def unique_or_fail(df: DataFrame, key: str, what: str) -> DataFrame:
    """Rows unchanged; the job fails when a key repeats.

    The running row number is partitioned by the join key, so the guard and the join share one
    shuffle and one sort instead of grouping every key beforehand.  The frame is a running one:
    nothing is buffered, also for a key that repeats a billion times.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"duplicate {key} in {what}: "), F.col(key).cast("string"))
    checked = df.withColumn("__nth", nth)
    return checked.where(
        F.when(F.col("__nth") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    ).drop("__nth")


def join_one_to_one(left: DataFrame, right: DataFrame, key: str, suffix: str = "_identity",
                    flag: str | None = None) -> DataFrame:
    """Left join with keys proven unique on both sides, so every left row comes out once.

    Right columns that collide get the suffix.  ``flag`` adds a column telling whether the right
    side was there: a nullable data column would not be a safe sign of that.
    """
    taken = set(left.columns) - {key}
    renamed = right.select(*[
        F.col(f"`{c}`").alias(c + suffix if c in taken else c) for c in right.columns
    ])
    if flag:
        renamed = renamed.withColumn(flag, F.lit(True))
    joined = unique_or_fail(left, key, "the left table").join(
        unique_or_fail(renamed, key, "the right table"), key, "left")
    if flag:
        joined = joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return joined


def join_coverage(joined: DataFrame, flag: str) -> DataFrame:
    """How many joined rows found a partner."""
    return joined.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col(flag)).alias("matched"),
        F.count_if(~F.col(flag)).alias("unmatched"),
        percent(F.count_if(F.col(flag)), F.count("*")).alias("coverage"),
    )


def assert_same_rows(before: DataFrame, after: DataFrame) -> int:
    """Row-count preservation; both counts read no data columns."""
    a, b = before.count(), after.count()
    if a != b:
        raise ValueError(f"row count changed from {a} to {b}")
    return a


def known_subset(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of a big keyed table whose key is among ``keys`` (distinct).

    A counted small key set is broadcast, so the table is filtered where it lies; beyond the bound
    both sides are shuffled.
    """
    few = keys.count() <= BROADCAST_ROWS
    return table.join(F.broadcast(keys) if few else keys, key, "left_semi")


def spread_join(left: DataFrame, right: DataFrame, key: str, salts: int = 64, hot_share: float = 0.001) -> DataFrame:
    """Left join to a table with unique keys when some left keys own a large share of the rows.

    Rows without a key match nothing and are spread too.  Keys above ``hot_share`` of the rows number fewer than ``1 / hot_share``, so that list is small
    enough to broadcast.  Their rows spread over ``salts`` partitions and their single right row is
    copied as often; all other keys keep one copy.
    """
    rows = left.agg(F.count(key)).scalar()
    hot = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where(
        F.col("__n") > rows * hot_share).select(key, F.lit(True).alias("__hot"))
    hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    salted = left.join(hot, key, "left").withColumn(
        "__salt", F.when(F.col("__hot") | F.col(key).isNull(), spread).otherwise(0)).drop("__hot")
    copies = right.join(hot, key, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), F.when(F.col("__hot"), salts - 1).otherwise(0)))
    ).drop("__hot")
    return salted.join(copies, [key, "__salt"], "left").drop("__salt")


def recent_joined(predictions: DataFrame, transactions: DataFrame, key: str, order: list[Column],
                  n: int = 100) -> DataFrame:
    """The newest n predictions with their transaction, if any.

    The limit runs before the join: transaction keys are unique, so it selects the same rows, and
    only n keys meet the transaction table.  The n rows are stored, as the join reads them twice and
    the log should be scanned once.
    """
    newest = materialise(predictions.orderBy(*order).limit(n), "newest")
    # At most n keys and, the key being unique, at most n transactions.
    mine = transactions.join(F.broadcast(newest.select(key).distinct()), key, "left_semi")
    return newest.join(F.broadcast(mine), key, "left")


RECENT_NAMES = {
    # fixed values: column names of the recent-activity report
    "transaction_id": "TransactionID", "transaction_amt": "Amount", "product_cd": "Product",
    "card4": "CardNetwork", "fraud_probability": "FraudProbability",
    "fraud_prediction": "IsFraud", "decision": "Decision",
    "prediction_latency_ms": "LatencyMs", "created_at": "Timestamp",
}


def recent_activity(predictions: DataFrame, transactions: DataFrame, n: int = 100) -> DataFrame:
    """The recent-activity report over the stored tables."""
    order = [F.desc("created_at"), F.desc("transaction_id")]
    right = transactions.select("transaction_id", "transaction_amt", "product_cd", "card4")
    rows = recent_joined(predictions, right, "transaction_id", order, n)
    return rows.select(*[F.col(c).alias(a) for c, a in RECENT_NAMES.items()])


def with_decision(report: DataFrame, choice: str = "all", column: str = "Decision") -> DataFrame:
    """All rows, the flagged ones or the legitimate ones."""
    wanted = {"all": None, "fraud": fixed.REVIEW, "legitimate": fixed.LEGITIMATE}[choice]
    return report if wanted is None else report.where(F.col(column) == wanted)


def children_newest_first(parents: DataFrame, children: DataFrame, key: str,
                          newest: list[Column]) -> DataFrame:
    """Children of the given parents, per parent newest first.

    Sorted by range, so the children of one busy parent spread over several tasks; no list per
    parent is ever built.
    """
    return children.join(parents.select(key).distinct(), key, "left_semi").orderBy(key, *newest)
