"""Catalogue: what must hold of fitted models, whatever numbers a fit comes to."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import evaluate, explain, models, topk
from cardwarden.plans import risk
from cardwarden.plans.catalog import query, table
from cardwarden.plans.inputs import CARD_SQL
from cardwarden.plans.modelling import (
    CARD_NUMERIC, CARD_TEXT, boosted, card_table, curve, gbt_score, gbt_score_missing_routed, gbt_score_regularised,
    gbt_score_without_indicators, linear, prepared, scored_part, stream_model_score)
from cardwarden.session import materialise

LABEL = f"actual_{fixed.TARGET}"
PARTS_SQL = f"""{CARD_SQL}, parts AS (
  SELECT *, CASE WHEN rn < trunc(n * 0.70::DOUBLE) THEN 'train' WHEN rn < trunc(n * 0.85::DOUBLE) THEN 'valid' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rn, count(*) OVER () AS n FROM card))"""
NAMES = [*CARD_NUMERIC, *[c + fixed.MISSING_SUFFIX for c in [*CARD_NUMERIC, *CARD_TEXT]], *CARD_TEXT]
NAMES_SQL = "(SELECT unnest([" + ", ".join(f"'{n}'" for n in NAMES) + "]) AS feature)"


def _p():
    return F.col("fraud_probability")


def _sound(scored: DataFrame) -> DataFrame:
    """Each row with whether its probability lies in range and flag and decision follow from it."""
    agree = _p().between(0, 1) & (F.col("fraud_prediction") == (_p() >= F.col("threshold"))) & (
        F.col("decision") == F.when(_p() >= F.col("threshold"), fixed.REVIEW).otherwise(fixed.LEGITIMATE))
    return scored.select(fixed.ID, agree.alias("sound"))


@query("logistic_scores_sound", f"""WITH {PARTS_SQL}
SELECT TransactionID, isFraud AS {LABEL}, true AS sound FROM parts WHERE split = 'valid'""")
def logistic_scores_sound(spark, sf):
    valid = risk.part(prepared(spark, sf), "valid")
    scored = linear(spark, sf).score(valid, [fixed.ID, fixed.TARGET])
    return scored.select(fixed.ID, F.col(fixed.TARGET).alias(LABEL), _p().between(0, 1).alias("sound"))


@query("boosted_scores_sound", f"""WITH {PARTS_SQL}
SELECT model, TransactionID, true AS sound FROM parts
CROSS JOIN (SELECT unnest(['with indicators', 'without', 'regularised', 'routed']) AS model) WHERE split = 'test'""")
def boosted_scores_sound(spark, sf):
    fits = {"with indicators": gbt_score, "without": gbt_score_without_indicators,
            "regularised": gbt_score_regularised, "routed": gbt_score_missing_routed}
    prepared(spark, sf)  # before the fits, which share it and run at the same time
    with ThreadPoolExecutor(len(fits)) as pool:
        scored = list(pool.map(lambda scores: scores(spark, sf), fits.values()))
    return reduce(DataFrame.unionByName, [
        _sound(scores).withColumn("model", F.lit(name)) for name, scores in zip(fits, scored)])


@query("importance_complete", f"""
SELECT feature, true AS in_range, 1.0::DOUBLE AS total FROM {NAMES_SQL}""")
def importance_complete(spark, sf):
    """One importance per assembled name; together they are one."""
    found = models.feature_importance(boosted(spark, sf))
    total = found.agg(F.round(F.sum("importance"), 9).alias("total"))
    # One row.
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range")).join(F.broadcast(total))


@query("validation_curve_agrees", f"""
SELECT part, iteration::INTEGER AS iteration, true AS agrees
FROM (SELECT unnest(range(1, {fixed.TREES + 1})) AS iteration) CROSS JOIN (SELECT unnest(['train', 'valid']) AS part)""")
def validation_curve_agrees(spark, sf):
    """A row per tree and part, in range; the last is the average precision of the whole model's scores."""
    wanted = []
    for part in ("train", "valid"):
        scored = scored_part(spark, sf, part)
        wanted.append(evaluate.ranking_metrics(scored, "fraud_probability", LABEL).select(
            F.lit(part).alias("part"), F.col("average_precision").alias("wanted")))
    joined = curve(spark, sf).join(F.broadcast(wanted[0].unionByName(wanted[1])), "part")
    # Margins beyond 36 meet in the probability 1, so the last digits may differ.
    close = F.abs(F.col("average_precision") - F.col("wanted")) < 1e-9
    last = F.col("iteration") == fixed.TREES
    return joined.select("part", "iteration", (F.col("average_precision").between(0, 1) & (close | ~last)).alias("agrees"))


@query("threshold_counts_agree", f"""WITH {PARTS_SQL}
SELECT split, threshold, count(*) AS total_rows, sum(isFraud)::BIGINT AS positives, true AS agrees FROM parts
CROSS JOIN (SELECT unnest([0.5, 0.6, 0.7])::DOUBLE AS threshold) WHERE split <> 'train' GROUP BY 1, 2""")
def threshold_counts_agree(spark, sf):
    """The confusion counts at the operating thresholds, recounted from stored scores one by one."""
    data, model = prepared(spark, sf), boosted(spark, sf)
    judged = materialise(risk.judge(model, data), "judged")
    found = []
    for part in ("valid", "test"):
        scored = scored_part(spark, sf, part)
        for t in fixed.TEST_THRESHOLDS:
            hit, bad = _p() >= t, F.col(LABEL) == 1
            found.append(scored.agg(
                F.lit(part).alias("split"), F.lit(t).alias("threshold"), F.count("*").alias("total_rows"),
                F.count_if(bad).alias("positives"), F.count_if(hit & bad).alias("tp"), F.count_if(hit & ~bad).alias("fp")))
    again = reduce(DataFrame.union, found)
    agrees = (F.col("tp") == F.col("true_positives")) & (F.col("fp") == F.col("false_positives")) & (
        F.col("total_rows") == F.col("true_positives") + F.col("false_positives") + F.col("true_negatives") + F.col("false_negatives"))
    return again.join(judged, ["split", "threshold"]).select("split", "threshold", "total_rows", "positives", agrees.alias("agrees"))


@query("evaluation_agrees", f"""WITH {PARTS_SQL}
SELECT split, count(*) FILTER (isFraud = 1) AS positives, count(*) FILTER (isFraud = 0) AS negatives, true AS sound
FROM parts WHERE split <> 'train' GROUP BY 1""")
def evaluation_agrees(spark, sf):
    """The evaluation of both held-out parts: whole counts, metrics in range, chosen thresholds in the sweep."""
    def one(part):
        scored = scored_part(spark, sf, part)
        b = evaluate.evaluation_bundle(scored, "fraud_probability", LABEL, part)
        sound = F.col("roc_auc").between(0, 1) & F.col("average_precision").between(0, 1) & (F.col("threshold") == 0.5)
        return b.select("split", (F.col("true_positives") + F.col("false_negatives")).alias("positives"),
                        (F.col("true_negatives") + F.col("false_positives")).alias("negatives"), sound.alias("sound"))
    return one("valid").unionByName(one("test"))


@query("attributions_complete", f"""WITH {PARTS_SQL}
SELECT TransactionID, {len(NAMES)}::BIGINT AS features FROM parts WHERE split = 'valid'""")
def attributions_complete(spark, sf):
    """Every validated row has one attribution per assembled feature."""
    model = boosted(spark, sf)
    values = explain.tree_attributions(model, risk.part(prepared(spark, sf), "valid"), fixed.ID)
    return explain.long_attributions(values, model.names, fixed.ID).groupBy(fixed.ID).agg(F.count_distinct("feature").alias("features"))


@query("sampled_ranking_agrees", f"SELECT least({len(NAMES)}, 20)::BIGINT AS ranked, true AS agrees")
def sampled_ranking_agrees(spark, sf):
    """The ranking over the sample is the mean absolute attribution of the same ids."""
    model = boosted(spark, sf)
    sample = topk.sample_rows(risk.part(prepared(spark, sf), "valid"), fixed.ID, fixed.ATTRIBUTION_SAMPLE)
    long = materialise(explain.long_attributions(
        explain.tree_attributions(model, materialise(sample, "sample"), fixed.ID), model.names, fixed.ID), "long")
    means = long.groupBy("feature").agg(F.avg(F.abs("value")).alias("wanted"))
    ranking = explain.global_ranking(long).join(means, "feature")
    return ranking.agg(F.count("*").alias("ranked"), F.bool_and(F.abs(F.col("mean_abs") - F.col("wanted")) < 1e-9).alias("agrees"))


@query("stream_model_agrees", "SELECT event_id AS transaction_id, true AS agrees FROM events")
def stream_model_agrees(spark, sf):
    """The stream's stored scores are those of a batch over the same requests."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("TransactionID"), F.col("event_id").alias("TransactionDT"),
        (F.col("value") * 1000).alias("TransactionAmt"), F.lit("O").alias("ProductCD"),
        F.col("event_type").alias("card4"), (F.col("value") / 100).alias("C1"))
    batch = linear(spark, sf).score(rows, [fixed.ID]).select(
        F.col(fixed.ID).alias("transaction_id"), F.col("fraud_probability").alias("p"))
    stored = stream_model_score(spark, sf).select("transaction_id", "fraud_probability")
    return stored.join(batch, "transaction_id").select(
        "transaction_id", (F.abs(F.col("fraud_probability").cast("double") - F.col("p")) < 1e-9).alias("agrees"))


@query("small_linear_model", f"""WITH {PARTS_SQL}
SELECT TransactionID, true AS sound FROM parts WHERE split = 'valid'""")
def small_linear_model(spark, sf):
    """The linear model on its fixed fifteen columns; the given tables lack some, which count as missing."""
    data = prepared(spark, sf)
    text = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]
    present = [c for c in fixed.BASELINE_FEATURES if c in card_table(spark, sf).columns]
    model = models.fit_linear(risk.part(data, "train"), [c for c in present if c not in text], [c for c in present if c in text])
    return _sound(model.score(risk.part(data, "valid"), [fixed.ID]))
