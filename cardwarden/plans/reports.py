"""Catalogue: the guarded flagship path and the reports over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import drift, evaluate, joins, missingness, quality
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.plans.inputs import CARD_SQL, PRICED_SQL, card_transactions
from cardwarden.plans.scoring import CONFUSION_SQL, RATES, RATES_SQL, ROUNDED_RATES, _thresholds_sql
from cardwarden.schemas import select_features

IDENTITY = ["card6", "addr1", "dist1"]
MERGED = ["TransactionAmt", "ProductCD", "card1", "card4", *IDENTITY, "C1", "V1", "V2"]
MERGED_SQL = f"""{CARD_SQL}, merged AS (
  SELECT TransactionID, TransactionDT, TransactionAmt, ProductCD, card1, card4, C1, V1, V2, isFraud,
         {', '.join(f"CASE WHEN card6 <> 'BUILDING' THEN {c} END AS {c}" for c in IDENTITY)} FROM card)"""


def merged(spark, sf):
    """Transactions with their optional identity record, one to one or not at all."""
    card = card_transactions(spark, sf)
    identity = card.where("card6 <> 'BUILDING'").select("TransactionID", *IDENTITY)
    return joins.join_one_to_one(card.drop(*IDENTITY), identity, "TransactionID")


@query("merged_target_rate_by_missing_count", f"""WITH {MERGED_SQL}
SELECT {' + '.join(f'({c} IS NULL)::INTEGER' for c in MERGED)} AS missing_count, count(isFraud) AS transactions,
       sum(isFraud)::BIGINT AS fraud_count, round(avg(isFraud), 6) AS fraud_rate FROM merged GROUP BY 1 HAVING count(isFraud) >= 100""")
def merged_target_rate_by_missing_count(spark, sf):
    """Guarded join, row-wise missing count, target rate: the path from raw tables to a finding."""
    return rounded(missingness.rate_by_missing_count(merged(spark, sf), MERGED, fixed.TARGET), fraud_rate=6)


@query("frame_report", f"""WITH {MERGED_SQL}
SELECT count(*) AS total_rows, count(*) = 0 AS empty, '' AS repeated_names, concat_ws(',', {', '.join(
    f"CASE WHEN count(*) > count({c}) THEN '{c}' END" for c in
    ["TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card4", "C1", "V1", "V2", "isFraud", *IDENTITY])}) AS missing_columns
FROM merged""")
def frame_report(spark, sf):
    return quality.frame_report(merged(spark, sf))


@query("selected_features", f"""WITH {MERGED_SQL}
SELECT TransactionDT, TransactionAmt, ProductCD, card1, card4, card6, addr1, dist1, C1, V1, V2 FROM merged""")
def selected_features(spark, sf):
    """The feature families as a projection, family by family."""
    rows = merged(spark, sf)
    return rows.select(*select_features(rows.columns))


@query("recent_activity", f"""
SELECT event_id AS TransactionID, value::DECIMAL(18,6) AS Amount, event_type AS Product, NULL::VARCHAR AS CardNetwork,
       round(value / 500.0::DOUBLE, 6) AS FraudProbability, value / 500.0::DOUBLE >= 0.15::DOUBLE AS IsFraud,
       CASE WHEN value / 500.0::DOUBLE >= 0.15::DOUBLE THEN '{fixed.REVIEW}' ELSE '{fixed.LEGITIMATE}' END AS Decision,
       round(json_extract_string(props, '$.k')::DOUBLE / 200.0::DOUBLE * 1000, 4) AS LatencyMs, ts AS Timestamp
FROM events ORDER BY ts DESC, event_id DESC LIMIT 100""")
def recent_activity(spark, sf):
    """The newest hundred predictions with their transactions, under the report's names."""
    from cardwarden.plans.inputs import prediction_log
    log = prediction_log(spark, sf).select(
        F.col("event_id").alias("transaction_id"), F.round("fraud_probability", 6).alias("fraud_probability"), "fraud_prediction",
        "decision", F.round(F.col("latency_seconds") * 1000, 4).alias("prediction_latency_ms"), "created_at")
    sent = table(spark, sf, "events").select(
        F.col("event_id").alias("transaction_id"), F.col("value").cast("string").cast("decimal(18,6)").alias("transaction_amt"),
        F.col("event_type").alias("product_cd"), F.lit(None).cast("string").alias("card4"))
    return joins.recent_activity(log, sent)


DRIFT_BOUNDS = [25000.0, 50000.0, 100000.0, 150000.0, 200000.0, 250000.0, 300000.0]
MIDDLE = "1995-01-01"


@query("drift_psi", f"""
WITH o AS (SELECT o_totalprice AS v, o_orderdate >= TIMESTAMP '{MIDDLE}' AS later FROM orders),
b AS (SELECT {' + '.join(f'(v >= {x}::DOUBLE)::INTEGER' for x in DRIFT_BOUNDS)} AS bin, count(*) FILTER (NOT later) AS before,
             count(*) FILTER (later) AS after FROM o GROUP BY 1),
s AS (SELECT *, greatest(coalesce(before / nullif(sum(before) OVER (), 0), 0), 0.0001::DOUBLE) AS p,
             greatest(coalesce(after / nullif(sum(after) OVER (), 0), 0), 0.0001::DOUBLE) AS q FROM b)
SELECT bin, before, after, round((q - p) * ln(q / p), 9) AS psi FROM s""")
def drift_psi(spark, sf):
    """Drift of order totals between two stretches of time, over fixed bins."""
    later = F.col("o_orderdate") >= F.lit(MIDDLE).cast("timestamp_ntz")
    return rounded(drift.population_stability(table(spark, sf, "orders"), "o_totalprice", DRIFT_BOUNDS, later), psi=9)


@query("ranking_by_period", f"""
WITH s AS (SELECT year(l_shipdate)::INTEGER AS period, l_extendedprice / 110000.0::DOUBLE AS score, (l_returnflag = 'R')::INTEGER AS label FROM lineitem),
g AS (SELECT period, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM s GROUP BY 1, 2),
c AS (SELECT period, pos, neg, sum(neg) OVER (PARTITION BY period ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER (PARTITION BY period) AS p, sum(neg) OVER (PARTITION BY period) AS q FROM g)
SELECT period, max(p)::BIGINT AS positives, max(q)::BIGINT AS negatives,
       round(sum(pos::DOUBLE * (2 * (q - fp) + neg)) / (2.0 * max(p)::DOUBLE * max(q)), 6) AS roc_auc FROM c GROUP BY 1""")
def ranking_by_period(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("period"), (F.col("l_extendedprice") / 110000.0).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return rounded(evaluate.ranking_by(lines, "score", "label", "period"), roc_auc=6)


SHARP_SQL = PRICED_SQL.replace("l_returnflag = 'R'", "l_quantity >= 30")


@query("best_threshold_recall_at_half_precision", f"""
WITH {SHARP_SQL}, {_thresholds_sql(fixed.SWEEP_THRESHOLDS)}, {CONFUSION_SQL}, {RATES_SQL}
SELECT {ROUNDED_RATES} FROM rates WHERE rates.precision >= 0.5 ORDER BY rates.recall DESC, threshold LIMIT 1""")
def best_threshold_recall_at_half_precision(spark, sf):
    """The fixed constraint, on a score that can meet it."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 110000.0).alias("score"), (F.col("l_quantity") >= 30).cast("int").alias("label"))
    sweep = evaluate.threshold_sweep(lines, "score", "label")
    return rounded(evaluate.best_threshold(sweep, "recall", ("precision", 0.5)), **RATES)
