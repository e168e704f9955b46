"""Risk models: fitting, scoring, importance, persistence."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions.decision import decision, flagged
from cardwarden.operators import boosting
from cardwarden.operators.evaluate import class_weights
from cardwarden.operators.features import CodeLookup, feature_inputs, feature_names, fit_features, label_weight
from cardwarden.schemas import conform
from cardwarden.session import fill_cores, materialise, use_checkpoints

SCORE_COLUMNS = ["fraud_probability", "fraud_prediction", "decision", "threshold", "prediction_latency_ms"]


@dataclass
class RiskModel:
    """Fitted transforms, the raw columns they were fitted on, and a linear classifier as last stage
    or a forest beside them."""

    pipeline: PipelineModel
    inputs: T.StructType
    forest: boosting.Forest | None = None

    @property
    def classifier(self):
        return self.forest if self.forest is not None else self.pipeline.stages[-1]

    @property
    def transforms(self) -> list:
        return self.pipeline.stages if self.forest is not None else self.pipeline.stages[:-1]

    @property
    def names(self) -> list[str]:
        return feature_names(self.pipeline)

    def prepare(self, df: DataFrame, keep: list[str] = (), extras: str | None = None) -> DataFrame:
        """Any input brought to the fitted columns: absent ones null, others dropped.

        Kept columns travel as one struct, so they may share names with the inputs.
        """
        kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.struct(F.lit(1).alias("row"))
        return conform(df.withColumn("__kept", kept), self.inputs, ["__kept"], extras)

    def _unpacked(self, keep: list[str]) -> list:
        return [F.col(f"__kept.`{c}`").alias(c) for c in keep]

    def features(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        """The kept columns and the assembled vector."""
        rows = self.prepare(df, keep)
        for stage in self.transforms:
            rows = stage.transform(rows)
        return rows.select(*self._unpacked(keep), "features")

    def score(self, df: DataFrame, keep: list[str] = (), threshold: float = fixed.THRESHOLD,
              extras: str | None = None) -> DataFrame:
        """Probability, flag, decision and threshold of every row, next to the kept columns.

        Latency is not known per row inside a distributed job; a caller that times a whole batch
        fills it in.
        """
        scored = self.pipeline.transform(self.prepare(df, keep, extras))
        if self.forest is not None:
            p = 1.0 / (1.0 + F.exp(-boosting.margin_column(df.sparkSession, self.forest, vector_to_array("features"))))
        else:
            p = vector_to_array("probability")[1]
        return scored.select(*self._unpacked(keep), p.alias("fraud_probability")).select(
            *keep, "fraud_probability",
            flagged(F.col("fraud_probability"), threshold).alias("fraud_prediction"),
            decision(F.col("fraud_probability"), threshold).alias("decision"),
            F.lit(threshold).alias("threshold"),
            F.lit(None).cast("double").alias("prediction_latency_ms"))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        stages = []
        for i, stage in enumerate(self.pipeline.stages):
            if isinstance(stage, CodeLookup):  # the table goes where the model goes
                stage.codes(spark).write.mode("overwrite").parquet(f"{path}/codes/{i}")
                stage = stage.copy({stage.path: f"{path}/codes/{i}"})
            stages.append(stage)
        PipelineModel(stages).write().overwrite().save(f"{path}/pipeline")
        shape = None
        if self.forest is not None:
            self.forest.save(spark, f"{path}/trees")
            shape = json.dumps({"trees": len(self.forest), "depth": self.forest.depth, "width": self.forest.width})
        spark.createDataFrame([(self.inputs.json(), shape)], "inputs string, forest string").coalesce(1).write.mode(
            "overwrite").parquet(f"{path}/inputs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RiskModel:
        about = spark.read.parquet(f"{path}/inputs").first()
        forest = boosting.Forest.load(spark, f"{path}/trees", **json.loads(about.forest)) if about.forest else None
        pipeline = PipelineModel.load(f"{path}/pipeline")
        for i, stage in enumerate(pipeline.stages):
            if isinstance(stage, CodeLookup):  # also where the model was moved
                stage.set(stage.path, f"{path}/codes/{i}")
        model = cls(pipeline, T.StructType.fromJson(json.loads(about.inputs)), forest)
        model.check()
        return model

    def check(self) -> None:
        """The contract between inputs, assembled names and classifier; broken ones raise on load."""
        names = self.names
        wanted = self.forest.width if self.forest is not None else self.classifier.numFeatures
        if len(names) != wanted:
            raise ValueError(f"the classifier expects {wanted} features, the assembler gives {len(names)}")
        absent = [c for c in feature_inputs(self.pipeline) if c not in self.inputs.names]
        if absent:
            raise ValueError(f"features without an input: {absent}")


def score_external(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], np.ndarray]],
                   inputs: T.StructType, key: str, threshold: float = fixed.THRESHOLD) -> DataFrame:
    """Scoring by a model that is not a Spark ML one.

    ``load`` runs once per task and returns a function from a batch of input columns to
    probabilities; batches arrive as Arrow data, the decision is taken on the Spark side.
    """
    rows = conform(df, inputs, [key])
    kind = rows.schema[key].dataType.simpleString()

    def run(batches):
        predict = load()
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "fraud_probability": predict(batch[inputs.names])})

    p = F.col("fraud_probability")
    return rows.mapInPandas(run, f"`{key}` {kind}, fraud_probability double").select(
        key, p, flagged(p, threshold).alias("fraud_prediction"), decision(p, threshold).alias("decision"),
        F.lit(threshold).alias("threshold"), F.lit(None).cast("double").alias("prediction_latency_ms"))


def _inputs(numeric: list[str], categorical: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.DoubleType()) for c in numeric]
                        + [T.StructField(c, T.StringType()) for c in categorical])


def _ready(train: DataFrame, numeric, categorical, label, balanced, **features) -> tuple:
    """Fitted transforms and (features, label, weight) of the training rows.

    ``train`` should be a stored table: its columns are scanned once per statistics pass.
    """
    use_checkpoints(train.sparkSession)
    inputs = _inputs(numeric, categorical)
    rows = conform(train, inputs, keep=[label])
    transforms = fit_features(rows, numeric, categorical, **features)
    weights = class_weights(rows, label).first()
    if not weights.positives:
        raise ValueError("no positive row to learn from")
    ready = transforms.transform(rows).select(
        "features", F.col(label).cast("double").alias("label"),
        label_weight(weights, label, balanced).alias("weight"))
    return inputs, transforms, weights, ready


def fit_linear(train: DataFrame, numeric: list[str], categorical: list[str], label: str = fixed.TARGET,
               iterations: int = fixed.LINEAR_ITERATIONS) -> RiskModel:
    """Balanced logistic regression on one-hot features.

    The penalty equals a unit penalty on the summed loss; class weights add up to the row count.
    """
    inputs, transforms, w, ready = _ready(train, numeric, categorical, label, True, encoding="onehot")
    classifier = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=iterations,
        regParam=1.0 / max(w.positives + w.negatives, 1), standardization=False).fit(fill_cores(ready))
    return RiskModel(PipelineModel([*transforms.stages, classifier]), inputs)


def fit_boosted(train: DataFrame, numeric: list[str], categorical: list[str], label: str = fixed.TARGET,
                indicators: bool = True, settings: dict | None = None, trees: int = fixed.TREES,
                impute: bool = True) -> RiskModel:
    """Boosted trees with positives weighted by neg/pos; ``settings`` override the fixed ones.

    With ``impute=False`` missing numbers reach the trees, which learn a side for them at each split.
    """
    chosen = boosting.Settings(**{"trees": trees, **fixed.BOOSTED, **(settings or {})})
    inputs, transforms, _, ready = _ready(
        train, numeric, categorical, label, False, indicators=indicators, numeric_fill=impute,
        categorical_fill="most_frequent" if indicators else "constant")
    rows = materialise(ready.select(
        F.monotonically_increasing_id().alias("row"), vector_to_array("features").alias("x"), "label", "weight"), "matrix")
    return RiskModel(transforms, inputs, boosting.fit(rows, chosen))


def precision_curve(model: RiskModel, parts: dict[str, DataFrame], label: str = fixed.TARGET) -> DataFrame:
    """(part, iteration, average_precision): exact after every tree, on every part.

    Only reported; training is not stopped by it.
    """
    rows = None
    for name, df in parts.items():
        one = model.features(df, [label]).select(F.lit(name).alias("part"), label, vector_to_array("features").alias("x"))
        rows = one if rows is None else rows.unionByName(one)
    return boosting.average_precision_by_tree(fill_cores(rows.where(F.col(label).isNotNull())), model.forest, "part", label)


def feature_importance(model: RiskModel) -> DataFrame:
    """(feature, importance), one row per model input.

    Trees: the mean gain of the splits on a feature, as a share of all.  Linear: |coefficient|.
    """
    values = model.forest.importance() if model.forest is not None else np.abs(model.classifier.coefficients.toArray())
    names = model.names
    if len(values) != len(names):
        raise ValueError("importance and feature names differ in number")
    return SparkSession.active().createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")


def top_features(model: RiskModel, n: int = 30) -> DataFrame:
    return feature_importance(model).orderBy(F.desc("importance"), "feature").limit(n)


def labelled_predictions(model: RiskModel, df: DataFrame, key: str = fixed.ID,
                         label: str = fixed.TARGET) -> DataFrame:
    """(key, actual label, probability): id and label ride along, nothing is joined back."""
    return model.score(df, [key, label]).select(
        key, F.col(label).alias(f"actual_{label}"), "fraud_probability")
