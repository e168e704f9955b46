"""The whole path: guarded join, chronological split, fit on the past, judge on the future."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import evaluate, joins, quality, split
from cardwarden.operators.models import RiskModel, labelled_predictions
from cardwarden.sinks.tables import write_table


def prepare(spark: SparkSession, transactions: DataFrame, identity: DataFrame, path: str) -> DataFrame:
    """Split transactions by time, join identity to them one to one, store one table by split.

    The join keeps every transaction once, so the split's passes read the stored transactions and the
    join is worked out only once.
    """
    quality.assert_frame(transactions, fixed.TARGET)
    parted = split.temporal_split(transactions, fixed.TIME, fixed.ID)
    write_table(joins.join_one_to_one(parted, identity.drop("split"), fixed.ID), path, ["split"])
    return spark.read.parquet(path)


def part(prepared: DataFrame, name: str) -> DataFrame:
    """One split; the others' files are not read."""
    return prepared.where(F.col("split") == name).drop("split")


def judge(model: RiskModel, prepared: DataFrame, thresholds: list[float] = fixed.TEST_THRESHOLDS) -> DataFrame:
    """Confusion and rates of the valid and test parts at the operating thresholds."""
    scored = [
        labelled_predictions(model, part(prepared, name)).withColumn("split", F.lit(name))
        for name in ("valid", "test")]
    return evaluate.threshold_sweep(
        scored[0].unionByName(scored[1]), "fraud_probability", f"actual_{fixed.TARGET}", thresholds, by=["split"])
