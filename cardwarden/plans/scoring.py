"""Catalogue: splits and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import evaluate, split, topk
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.plans.inputs import PRICED_SQL, SCORED_SQL, priced_lines, scored_lines

SPLIT_SQL = """parts AS (
  SELECT *, CASE WHEN rn <= trunc(n * 0.70::DOUBLE) THEN 'train' WHEN rn <= trunc(n * 0.85::DOUBLE) THEN 'valid'
                 ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders))"""


@query("temporal_split", f"WITH {SPLIT_SQL} SELECT o_orderkey, split FROM parts")
def temporal_split(spark, sf):
    return split.temporal_split(table(spark, sf, "orders"), "o_orderdate", "o_orderkey").select("o_orderkey", "split")


BIG = 2 ** 60


@query("temporal_split_large_ids", f"WITH {SPLIT_SQL} SELECT o_orderkey + {BIG} AS o_orderkey, split FROM parts")
def temporal_split_large_ids(spark, sf):
    """Ids that differ by less than a double can tell."""
    orders = table(spark, sf, "orders").withColumn("o_orderkey", F.col("o_orderkey") + F.lit(BIG))
    return split.temporal_split(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "split")


@query("split_summary", f"""WITH {SPLIT_SQL}
SELECT split, count(*) AS total_rows, sum((o_orderstatus = 'F')::INTEGER)::BIGINT AS fraud,
       count(*) - sum((o_orderstatus = 'F')::INTEGER)::BIGINT AS legitimate,
       round(sum((o_orderstatus = 'F')::INTEGER) * 100.0::DOUBLE / count(*), 6) AS fraud_rate,
       min(o_orderdate) AS first_time, max(o_orderdate) AS last_time FROM parts GROUP BY 1""")
def split_summary(spark, sf):
    parts = split.temporal_split(table(spark, sf, "orders"), "o_orderdate", "o_orderkey").withColumn(
        "isFraud", (F.col("o_orderstatus") == "F").cast("int"))
    return rounded(split.split_summary(parts, "o_orderdate", "isFraud"), fraud_rate=6)


def _thresholds_sql(thresholds):
    return "t AS (SELECT unnest([" + ", ".join(f"{t}::DOUBLE" for t in thresholds) + "]) AS threshold)"


CONFUSION_SQL = """conf AS (
  SELECT threshold, count(*) FILTER (score < threshold AND label = 0) AS true_negatives,
         count(*) FILTER (score >= threshold AND label = 0) AS false_positives,
         count(*) FILTER (score < threshold AND label = 1) AS false_negatives,
         count(*) FILTER (score >= threshold AND label = 1) AS true_positives
  FROM scored CROSS JOIN t GROUP BY 1)"""
RATES_SQL = """rates AS (
  SELECT *, coalesce(true_positives / nullif(true_positives + false_positives, 0), 0) AS precision,
         coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0) AS recall,
         coalesce(2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1,
         false_positives / nullif(false_positives + true_negatives, 0) AS false_positive_rate FROM conf)"""
ROUNDED_RATES = ("threshold, true_negatives, false_positives, false_negatives, true_positives, "
                 "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, "
                 "round(false_positive_rate, 6) AS false_positive_rate")
RATES = {"precision": 6, "recall": 6, "f1": 6, "false_positive_rate": 6}


@query("confusion_by_threshold", f"""
WITH {SCORED_SQL}, {_thresholds_sql(fixed.TEST_THRESHOLDS)}, {CONFUSION_SQL} SELECT * FROM conf""")
def confusion_by_threshold(spark, sf):
    return evaluate.confusion_by_threshold(scored_lines(spark, sf), "score", "label", fixed.TEST_THRESHOLDS)


@query("threshold_sweep", f"""
WITH {SCORED_SQL}, {_thresholds_sql(fixed.SWEEP_THRESHOLDS)}, {CONFUSION_SQL}, {RATES_SQL}
SELECT {ROUNDED_RATES} FROM rates""")
def threshold_sweep(spark, sf):
    return rounded(evaluate.threshold_sweep(scored_lines(spark, sf), "score", "label"), **RATES)


@query("threshold_sweep_fine_scores", f"""
WITH {PRICED_SQL}, {_thresholds_sql(fixed.SWEEP_THRESHOLDS)}, {CONFUSION_SQL}, {RATES_SQL}
SELECT {ROUNDED_RATES} FROM rates""")
def threshold_sweep_fine_scores(spark, sf):
    return rounded(evaluate.threshold_sweep(priced_lines(spark, sf), "score", "label"), **RATES)


@query("rates_by_period", f"""
WITH {SCORED_SQL.replace("AS label", "AS label, year(l_shipdate)::INTEGER AS period")}, {_thresholds_sql(fixed.TEST_THRESHOLDS)},
{CONFUSION_SQL.replace("SELECT threshold", "SELECT period, threshold").replace("GROUP BY 1", "GROUP BY 1, 2")}, {RATES_SQL}
SELECT period, {ROUNDED_RATES} FROM rates""")
def rates_by_period(spark, sf):
    """The operating thresholds judged period by period, still in one scan."""
    lines = table(spark, sf, "lineitem").select(
        (F.round(F.col("l_discount") * 100) / 10.0).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.year("l_shipdate").alias("period"))
    return rounded(evaluate.threshold_sweep(lines, "score", "label", fixed.TEST_THRESHOLDS, by=["period"]), **RATES)


def _best_sql(metric, where):
    return f"""
WITH {SCORED_SQL}, {_thresholds_sql(fixed.SWEEP_THRESHOLDS)}, {CONFUSION_SQL}, {RATES_SQL}
SELECT {ROUNDED_RATES} FROM rates WHERE {where} ORDER BY rates.{metric} DESC, threshold LIMIT 1"""


@query("best_threshold_f1", _best_sql("f1", "true"))
def best_threshold_f1(spark, sf):
    sweep = evaluate.threshold_sweep(scored_lines(spark, sf), "score", "label")
    return rounded(evaluate.best_threshold(sweep, "f1"), **RATES)


@query("best_threshold_precision_at_recall", _best_sql("precision", "rates.recall >= 0.5"))
def best_threshold_precision_at_recall(spark, sf):
    sweep = evaluate.threshold_sweep(scored_lines(spark, sf), "score", "label")
    return rounded(evaluate.best_threshold(sweep, "precision", ("recall", 0.5)), **RATES)


@query("best_threshold_recall_at_precision", _best_sql("recall", "rates.precision >= 0.3"))
def best_threshold_recall_at_precision(spark, sf):
    sweep = evaluate.threshold_sweep(scored_lines(spark, sf), "score", "label")
    return rounded(evaluate.best_threshold(sweep, "recall", ("precision", 0.3)), **RATES)


CURVE_SQL = """g AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY 1),
  c AS (SELECT pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS q
        FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
AUC_SQL = "round(sum(pos::DOUBLE * (2 * (q - fp) + neg)) / (2.0 * max(p)::DOUBLE * max(q)), 6) AS roc_auc"
AP_SQL = "round(sum(pos / p * (tp / (tp + fp))), 6) AS average_precision"


@query("roc_auc", f"WITH {SCORED_SQL}, {CURVE_SQL} SELECT {AUC_SQL} FROM c")
def roc_auc(spark, sf):
    return rounded(evaluate.ranking_metrics(scored_lines(spark, sf), "score", "label").select("roc_auc"), roc_auc=6)


@query("average_precision", f"WITH {SCORED_SQL}, {CURVE_SQL} SELECT {AP_SQL} FROM c")
def average_precision(spark, sf):
    out = evaluate.ranking_metrics(scored_lines(spark, sf), "score", "label").select("average_precision")
    return rounded(out, average_precision=6)


@query("ranking_metrics_fine_scores", f"""WITH {PRICED_SQL}, {CURVE_SQL}
SELECT max(p)::BIGINT AS positives, max(q)::BIGINT AS negatives, {AUC_SQL}, {AP_SQL} FROM c""")
def ranking_metrics_fine_scores(spark, sf):
    out = evaluate.ranking_metrics(priced_lines(spark, sf), "score", "label")
    return rounded(out, roc_auc=6, average_precision=6)


@query("classification_report", f"""WITH {SCORED_SQL}, t AS (SELECT 0.5::DOUBLE AS threshold), {CONFUSION_SQL},
f AS (SELECT true_positives AS tp, false_positives AS fp, false_negatives AS fn, true_negatives AS tn FROM conf),
m AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS n0,
             tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fn + fp) AS f1, tp + fn AS n1,
             tp + fp + fn + tn AS n, (tp + tn) / (tp + fp + fn + tn) AS acc FROM f),
u AS (SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS s FROM m
      UNION ALL SELECT '1', p1, r1, f1, n1 FROM m
      UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM m
      UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
      UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / n, (r0 * n0 + r1 * n1) / n, (f0 * n0 + f1 * n1) / n, n FROM m)
SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM u""")
def classification_report(spark, sf):
    out = evaluate.classification_report(scored_lines(spark, sf), "score", "label")
    return rounded(out, precision=6, recall=6, f1=6)


@query("evaluation_bundle", f"""WITH {SCORED_SQL}, t AS (SELECT 0.5::DOUBLE AS threshold), {CONFUSION_SQL}, {RATES_SQL},
{CURVE_SQL}, m AS (SELECT {AUC_SQL}, {AP_SQL} FROM c)
SELECT 'valid' AS split, {ROUNDED_RATES}, roc_auc, average_precision FROM rates, m""")
def evaluation_bundle(spark, sf):
    out = evaluate.evaluation_bundle(scored_lines(spark, sf), "score", "label", "valid")
    return rounded(out, roc_auc=6, average_precision=6, **RATES)


@query("class_weights", f"""WITH {SCORED_SQL}, n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scored)
SELECT p AS positives, q AS negatives, round(q / p, 6) AS scale_pos_weight,
       round((p + q) / (2 * p), 6) AS weight_1, round((p + q) / (2 * q), 6) AS weight_0 FROM n""")
def class_weights(spark, sf):
    return rounded(evaluate.class_weights(scored_lines(spark, sf), "label"), scale_pos_weight=6, weight_1=6, weight_0=6)


# --- top rows and samples ---------------------------------------------------------------------------

@query("top_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def top_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return topk.top(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 30)


@query("first_positive", "SELECT doc_id, quality, toxic FROM labels WHERE toxic = 1 ORDER BY doc_id LIMIT 1")
def first_positive(spark, sf):
    return topk.first_positive(table(spark, sf, "labels"), "toxic", "doc_id")


@query("sample_fixed_size", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey LIMIT 5000""")
def sample_fixed_size(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return topk.sample_rows(orders, "o_orderkey", fixed.ATTRIBUTION_SAMPLE)


@query("sample_one_row", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey LIMIT 1""")
def sample_one_row(spark, sf):
    return topk.sample_one(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
