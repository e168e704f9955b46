"""Catalogue: feature transforms, models, scoring, attributions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import evaluate, explain, features, joins, models, split, topk
from cardwarden.plans import risk
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.plans.inputs import CARD_SQL, GAPPY_SQL, card_transactions, gappy_lines
from cardwarden.plans.streams import bus_records, event_stream
from cardwarden.schemas import DOUBLE, schema_of
from cardwarden.session import materialise, work_path
from cardwarden.sinks.tables import write_bucketed
from cardwarden.streaming import jobs
from cardwarden.streaming.score_once import score_batch
from cardwarden.streaming.store import PredictionStore

# --- transforms -----------------------------------------------------------------------------------


@query("impute_median", f"""WITH {GAPPY_SQL}, m AS (SELECT median(C1) AS c, median(V1) AS v, median(V2) AS w FROM gappy)
SELECT round(coalesce(C1, c), 6) AS C1, round(coalesce(V1, v), 6) AS V1, round(coalesce(V2, w), 6) AS V2 FROM gappy, m""")
def impute_median(spark, sf):
    df = gappy_lines(spark, sf).select("C1", "V1", "V2")
    return rounded(features.impute(df, features.medians(df, df.columns)), C1=6, V1=6, V2=6)


@query("impute_mode", f"""WITH {GAPPY_SQL},
m AS (SELECT M1 AS v FROM gappy WHERE M1 IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, M1 LIMIT 1)
SELECT coalesce(M1, v) AS M1, count(*) AS n FROM gappy, m GROUP BY 1""")
def impute_mode(spark, sf):
    df = gappy_lines(spark, sf).select("M1")
    return features.impute(df, features.most_frequent(df, ["M1"])).groupBy("M1").agg(F.count("*").alias("n"))


@query("impute_constant", f"""WITH {GAPPY_SQL}
SELECT coalesce(M1, 'missing') AS M1, count(*) AS n FROM gappy GROUP BY 1""")
def impute_constant(spark, sf):
    df = gappy_lines(spark, sf).select("M1")
    return features.impute(df, {"M1": features.FILL_TEXT}).groupBy("M1").agg(F.count("*").alias("n"))


SEEN_SQL = "(SELECT DISTINCT o_orderpriority AS v FROM orders WHERE o_orderpriority <> '2-HIGH')"


@query("ordinal_encode", f"""WITH c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM {SEEN_SQL})
SELECT o_orderkey, coalesce(code, -1)::DOUBLE AS priority FROM orders LEFT JOIN c ON v = o_orderpriority""")
def ordinal_encode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    model = features.fit_features(orders.where("o_orderpriority <> '2-HIGH'"), [], ["o_orderpriority"])
    return model.transform(orders).select("o_orderkey", vector_to_array("features")[0].alias("priority"))


@query("one_hot", """
SELECT o_orderkey, (o_orderpriority = '1-URGENT')::DOUBLE AS urgent, (o_orderpriority = '3-MEDIUM')::DOUBLE AS medium,
       (o_orderpriority = '4-NOT SPECIFIED')::DOUBLE AS unspecified, (o_orderpriority = '5-LOW')::DOUBLE AS low FROM orders""")
def one_hot(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    model = features.fit_features(
        orders.where("o_orderpriority <> '2-HIGH'"), [], ["o_orderpriority"], encoding="onehot")
    slots = vector_to_array("features")
    return model.transform(orders).select("o_orderkey", *[
        slots[i].alias(n) for i, n in enumerate(["urgent", "medium", "unspecified", "low"])])


@query("ordinal_encode_many", """
WITH c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
           FROM (SELECT DISTINCT p_name AS v FROM part WHERE p_size <= 40))
SELECT p_partkey, coalesce(code, -1) AS code FROM part LEFT JOIN c ON v = p_name""")
def ordinal_encode_many(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    codes = features.ordinal_codes(part.where("p_size <= 40"), "p_name")
    return features.encode_by_join(part, "p_name", codes, "code").select("p_partkey", "code")


CARD_NUMERIC = ["TransactionAmt", "addr1", "dist1", "C1", "V1", "V2"]
CARD_TEXT = ["ProductCD", "card4", "card6"]
_MATRIX = [*CARD_NUMERIC, *[c + fixed.MISSING_SUFFIX for c in [*CARD_NUMERIC, *CARD_TEXT]], *CARD_TEXT]


@query("column_transformer", f"""WITH {CARD_SQL}, m AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in CARD_NUMERIC)} FROM card),
{', '.join(f"k_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM card))" for c in CARD_TEXT)}
SELECT TransactionID, {', '.join(f'round(coalesce({c}, m_{c}), 6) AS {c}' for c in CARD_NUMERIC)},
       {', '.join(f'({c} IS NULL)::INTEGER::DOUBLE AS {c}{fixed.MISSING_SUFFIX}' for c in [*CARD_NUMERIC, *CARD_TEXT])},
       {', '.join(f'k_{c}.code::DOUBLE AS {c}' for c in CARD_TEXT)}
FROM card CROSS JOIN m {' '.join(f'LEFT JOIN k_{c} ON k_{c}.v = card.{c}' for c in CARD_TEXT)}""")
def column_transformer(spark, sf):
    card = card_table(spark, sf)
    model = features.fit_features(card, CARD_NUMERIC, CARD_TEXT, indicators=True, categorical_fill="most_frequent")
    x = vector_to_array("features")
    out = model.transform(card).select("TransactionID", *[x[i].alias(n) for i, n in enumerate(features.feature_names(model))])
    return rounded(out, **dict.fromkeys(CARD_NUMERIC, 6))


ROWS_PER_FILE = 1_000_000

# --- models ---------------------------------------------------------------------------------------

_kept: dict[tuple, object] = {}


def _keep(spark, sf, name, make):
    """One table or model per session and data folder, shared by the queries that read it."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _kept:
        _kept[at] = make()
    return _kept[at]


def card_table(spark, sf):
    """The card transactions stored once: every fit scans them several times."""
    return _keep(spark, sf, "card", lambda: materialise(card_transactions(spark, sf), "card"))


def prepared(spark, sf):
    """Transactions ⟕ customer facts, guarded, split by time and stored by split."""
    def make():
        card = card_table(spark, sf)
        right = card.where("card6 <> 'BUILDING'").select("TransactionID", "card6", "addr1")
        return risk.prepare(spark, card.drop("card6", "addr1"), right, work_path(spark, "prepared"))
    return _keep(spark, sf, "prepared", make)


JOINED_SQL = f"""WITH {CARD_SQL}
SELECT TransactionID, CASE WHEN rn < trunc(n * 0.70::DOUBLE) THEN 'train' WHEN rn < trunc(n * 0.85::DOUBLE) THEN 'valid' ELSE 'test' END AS split,
       CASE WHEN card6 <> 'BUILDING' THEN card6 END AS card6, round(TransactionAmt, 4) AS TransactionAmt
FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rn, count(*) OVER () AS n FROM card)"""


@query("bucketed_join_and_split", JOINED_SQL)
def bucketed_join_and_split(spark, sf):
    """Guard, one-to-one join and split of two tables bucketed by the id: no row changes its place."""
    card = card_table(spark, sf)
    buckets = max(8, card.count() // ROWS_PER_FILE)
    at = work_path(spark, "bucketed")
    sides = {"transactions": card.drop("card6", "addr1"),
             "identity": card.where("card6 <> 'BUILDING'").select("TransactionID", "card6", "addr1")}
    names = {side: f"{side}_{at.rsplit('-', 1)[1]}" for side in sides}
    for side, rows in sides.items():
        write_bucketed(rows, names[side], fixed.ID, buckets, f"{at}/{side}")
    merged = joins.join_one_to_one(spark.table(names["transactions"]), spark.table(names["identity"]), fixed.ID)
    return rounded(split.temporal_split(merged, fixed.TIME, fixed.ID).select(
        fixed.ID, "split", "card6", "TransactionAmt"), TransactionAmt=4)


def fit_linear(spark, sf):
    return models.fit_linear(risk.part(prepared(spark, sf), "train"), CARD_NUMERIC, CARD_TEXT)


def fit_boosted(spark, sf):
    return models.fit_boosted(risk.part(prepared(spark, sf), "train"), CARD_NUMERIC, CARD_TEXT)


def fit_without_indicators(spark, sf):
    return models.fit_boosted(risk.part(prepared(spark, sf), "train"), CARD_NUMERIC, CARD_TEXT, indicators=False)


def fit_regularised(spark, sf):
    return models.fit_boosted(risk.part(prepared(spark, sf), "train"), CARD_NUMERIC, CARD_TEXT, settings=fixed.REGULARISED)


def fit_routed(spark, sf):
    """Missing numbers reach the trees, which learn a side for them at each split."""
    return models.fit_boosted(risk.part(prepared(spark, sf), "train"), CARD_NUMERIC, CARD_TEXT, indicators=False, impute=False)


def fresh(spark, sf, name, fit):
    """A new fit, which the queries that only read a model then share."""
    _kept.pop((spark.sparkContext.applicationId, sf, name), None)
    return _keep(spark, sf, name, lambda: fit(spark, sf))


def linear(spark, sf):
    return _keep(spark, sf, "linear", lambda: fit_linear(spark, sf))


def boosted(spark, sf):
    return _keep(spark, sf, "boosted", lambda: fit_boosted(spark, sf))


@query("logistic_score")
def logistic_score(spark, sf):
    model = fresh(spark, sf, "linear", fit_linear)
    return models.labelled_predictions(model, risk.part(prepared(spark, sf), "valid"))


@query("gbt_score")
def gbt_score(spark, sf):
    model = boosted(spark, sf)
    return model.score(risk.part(prepared(spark, sf), "test"), [fixed.ID])


def _boosted_by(spark, sf, name, fit):
    model = _keep(spark, sf, name, lambda: fit(spark, sf))
    return model.score(risk.part(prepared(spark, sf), "test"), [fixed.ID])


@query("gbt_score_without_indicators")
def gbt_score_without_indicators(spark, sf):
    return _boosted_by(spark, sf, "without", fit_without_indicators)


@query("gbt_score_regularised")
def gbt_score_regularised(spark, sf):
    return _boosted_by(spark, sf, "regularised", fit_regularised)


@query("gbt_score_missing_routed")
def gbt_score_missing_routed(spark, sf):
    return _boosted_by(spark, sf, "routed", fit_routed)


@query("saved_model_score")
def saved_model_score(spark, sf):
    path = work_path(spark, "model")
    linear(spark, sf).save(path)
    return models.RiskModel.load(spark, path).score(card_table(spark, sf), [fixed.ID])


def scored_part(spark, sf, part):
    """A held-out part scored by the boosted model, stored once: every report reads it several times."""
    return _keep(spark, sf, f"scored {part}", lambda: materialise(
        models.labelled_predictions(boosted(spark, sf), risk.part(prepared(spark, sf), part)), "scored"))


@query("model_evaluation")
def model_evaluation(spark, sf):
    label = f"actual_{fixed.TARGET}"
    one, other = (evaluate.evaluation_bundle(scored_part(spark, sf, part), "fraud_probability", label, part)
                  for part in ("valid", "test"))
    return one.unionByName(other)


@query("operating_points")
def operating_points(spark, sf):
    valid = scored_part(spark, sf, "valid")
    sweep = materialise(evaluate.threshold_sweep(valid, "fraud_probability", f"actual_{fixed.TARGET}"), "sweep")
    return evaluate.best_thresholds(sweep)


@query("test_thresholds")
def test_thresholds(spark, sf):
    return risk.judge(boosted(spark, sf), prepared(spark, sf))


@query("feature_importance")
def feature_importance(spark, sf):
    return models.top_features(boosted(spark, sf))


@query("validation_curve")
def validation_curve(spark, sf):
    """Average precision of the training and the held-out part after every tree."""
    return curve(spark, sf)


def curve(spark, sf):
    data = prepared(spark, sf)
    return _keep(spark, sf, "curve", lambda: materialise(models.precision_curve(
        boosted(spark, sf), {name: risk.part(data, name) for name in ("train", "valid")}), "curve"))


EXTERNAL = schema_of(TransactionAmt=DOUBLE, C1=DOUBLE, V1=DOUBLE)


def _external():
    """A fixed formula standing in for a model object loaded in every task."""
    import numpy as np

    def predict(x):
        z = 0.5 * x["C1"].fillna(0.0) + x["TransactionAmt"] / 500000.0 - 20.0 * x["V1"].fillna(0.0)
        return 1.0 / (1.0 + np.exp(-(z - 1.0)))
    return predict


@query("external_model_score", f"""WITH {CARD_SQL}, p AS (
  SELECT TransactionID, 1.0 / (1.0 + exp(-(0.5::DOUBLE * coalesce(C1, 0) + TransactionAmt / 500000.0::DOUBLE
         - 20.0::DOUBLE * coalesce(V1, 0) - 1.0))) AS p FROM card)
SELECT TransactionID, round(p, 6) AS fraud_probability, p >= 0.6::DOUBLE AS fraud_prediction,
       CASE WHEN p >= 0.6::DOUBLE THEN '{fixed.REVIEW}' ELSE '{fixed.LEGITIMATE}' END AS decision,
       0.6::DOUBLE AS threshold FROM p""")
def external_model_score(spark, sf):
    out = models.score_external(card_table(spark, sf), _external, EXTERNAL, fixed.ID)
    return rounded(out.drop("prediction_latency_ms"), fraud_probability=6)


VALID_ROWS = "(SELECT trunc(count(*) * 0.85::DOUBLE)::BIGINT - trunc(count(*) * 0.70::DOUBLE)::BIGINT FROM orders)"


@query("score_properties", f"""
SELECT {VALID_ROWS} AS total_rows, {VALID_ROWS} AS in_range, {VALID_ROWS} AS consistent""")
def score_properties(spark, sf):
    """Every row scored, in range, flag and decision agreeing with the threshold."""
    p = F.col("fraud_probability")
    agree = (F.col("fraud_prediction") == (p >= F.col("threshold"))) & (
        F.col("decision") == F.when(p >= fixed.THRESHOLD, fixed.REVIEW).otherwise(fixed.LEGITIMATE))
    scored = materialise(boosted(spark, sf).score(risk.part(prepared(spark, sf), "valid"), [fixed.ID]), "scored")
    return scored.agg(F.count_distinct(fixed.ID).alias("total_rows"), F.count_if(p.between(0, 1)).alias("in_range"),
                      F.count_if(agree).alias("consistent"))


@query("saved_model_agrees", "SELECT count(*) AS total_rows, count(*) AS equal FROM orders")
def saved_model_agrees(spark, sf):
    """A saved and reloaded model scores every row as the original does."""
    path, model = work_path(spark, "model"), linear(spark, sf)
    model.save(path)
    card = card_table(spark, sf)
    a = model.score(card, [fixed.ID]).select(fixed.ID, F.col("fraud_probability").alias("p"))
    b = models.RiskModel.load(spark, path).score(card, [fixed.ID]).select(fixed.ID, "fraud_probability")
    return a.join(b, fixed.ID).agg(
        F.count("*").alias("total_rows"), F.count_if(F.abs(F.col("p") - F.col("fraud_probability")) < 1e-12).alias("equal"))


# --- attributions ---------------------------------------------------------------------------------

@query("linear_attributions")
def linear_attributions(spark, sf):
    data = prepared(spark, sf)
    values = explain.linear_attributions(
        linear(spark, sf), risk.part(data, "valid"), risk.part(data, "train"), fixed.ID)
    return explain.long_attributions(values, linear(spark, sf).names, fixed.ID)


@query("tree_attributions")
def tree_attributions(spark, sf):
    values = explain.tree_attributions(boosted(spark, sf), risk.part(prepared(spark, sf), "valid"), fixed.ID)
    return explain.long_attributions(values, boosted(spark, sf).names, fixed.ID)


@query("sampled_attribution_ranking")
def sampled_attribution_ranking(spark, sf):
    model = boosted(spark, sf)
    sample = topk.sample_rows(risk.part(prepared(spark, sf), "valid"), fixed.ID, fixed.ATTRIBUTION_SAMPLE)
    values = explain.tree_attributions(model, materialise(sample, "sample"), fixed.ID)
    return explain.global_ranking(explain.long_attributions(values, model.names, fixed.ID))


ADDITIVE_SQL = f"SELECT {VALID_ROWS} AS total_rows, {VALID_ROWS} AS additive"


def _additive(values, scored):
    """Rows whose base and attributions give back the probability through the logistic function."""
    margin = F.col("base") + F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    p = 1 / (1 + F.exp(-margin))
    return values.select(fixed.ID, p.alias("p")).join(scored, fixed.ID).agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.abs(F.col("p") - F.col("fraud_probability")) < 1e-9).alias("additive"))


@query("linear_attributions_add_up", ADDITIVE_SQL)
def linear_attributions_add_up(spark, sf):
    model, data = linear(spark, sf), prepared(spark, sf)
    valid = risk.part(data, "valid")
    return _additive(explain.linear_attributions(model, valid, risk.part(data, "train"), fixed.ID),
                     model.score(valid, [fixed.ID]))


@query("tree_attributions_add_up", ADDITIVE_SQL)
def tree_attributions_add_up(spark, sf):
    model, valid = boosted(spark, sf), risk.part(prepared(spark, sf), "valid")
    return _additive(explain.tree_attributions(model, valid, fixed.ID), model.score(valid, [fixed.ID]))


LONG_SQL = """long AS (
  SELECT l_suppkey AS key, l_orderkey::VARCHAR || '-' || l_partkey::VARCHAR AS feature,
         l_extendedprice - 50000.0::DOUBLE AS value FROM lineitem)"""


def _long(spark, sf):
    v = F.col("l_extendedprice") - 50000.0
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("key"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("feature"),
        v.alias("value"), F.abs(v).alias("abs_value"))


@query("top_contributors", f"""WITH {LONG_SQL}, lists AS (
  SELECT 'overall' AS list, * FROM long UNION ALL SELECT 'positive', * FROM long WHERE value > 0
  UNION ALL SELECT 'negative', * FROM long WHERE value < 0)
SELECT key, list, rank, feature, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key, list ORDER BY abs(value) DESC, feature)::INTEGER AS rank FROM lists)
WHERE rank <= 10""")
def top_contributors(spark, sf):
    return explain.top_contributors(_long(spark, sf), "key").select("key", "list", "rank", "feature", "value")


@query("global_attribution_ranking", """
SELECT l_partkey::VARCHAR AS feature, round(avg(abs(l_extendedprice - 50000.0::DOUBLE)), 4) AS mean_abs
FROM lineitem GROUP BY 1 ORDER BY avg(abs(l_extendedprice - 50000.0::DOUBLE)) DESC, 1 LIMIT 20""")
def global_attribution_ranking(spark, sf):
    long = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("feature"), (F.col("l_extendedprice") - 50000.0).alias("value"))
    return rounded(explain.global_ranking(long), mean_abs=4)


# --- stream scoring -------------------------------------------------------------------------------

@query("stream_model_score")
def stream_model_score(spark, sf):
    """A fitted model inside the stream: parse, validate, conform, score, store once per id."""
    at = work_path(spark, "stream-model")
    model = linear(spark, sf)
    store = PredictionStore(spark, f"{at}/store")
    payload = [F.col("event_id").alias("TransactionID"), F.col("event_id").alias("TransactionDT"),
               (F.col("value") * 1000).alias("TransactionAmt"), F.lit("O").alias("ProductCD"),
               F.col("event_type").alias("card4"), (F.col("value") / 100).alias("C1")]

    def score(rows):
        return model.score(rows, rows.columns, extras="extras")

    handler = score_batch(store, score, "linear", "1", [F.col("offset")], f"{at}/rejects")
    jobs.finish(jobs.each_batch(bus_records(event_stream(spark, sf), payload), handler, f"{at}/checkpoint", True))
    return store.predictions()
