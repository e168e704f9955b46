"""Catalogue: prediction log, operational metrics, lifetimes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import counters, joins, lifetimes, metrics, predictions
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.plans.inputs import LOG_SQL, prediction_log
from cardwarden.session import work_path
from cardwarden.streaming import jobs, lookups
from cardwarden.streaming.store import PredictionStore



@query("latest_per_key", f"""WITH {LOG_SQL}
SELECT transaction_id, event_id, created_at, decision FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY created_at DESC, event_id DESC) AS rn FROM log)
WHERE rn = 1""")
def latest_per_key(spark, sf):
    log = prediction_log(spark, sf).select("transaction_id", "event_id", "created_at", "decision")
    return predictions.latest_per_key(log, "transaction_id", [F.col("created_at"), F.col("event_id")])


@query("recent_predictions", f"""WITH {LOG_SQL}
SELECT event_id, transaction_id, created_at, decision FROM log ORDER BY created_at DESC, event_id DESC LIMIT 20""")
def recent_predictions(spark, sf):
    log = prediction_log(spark, sf).select("event_id", "transaction_id", "created_at", "decision")
    return predictions.recent(log, [F.desc("created_at"), F.desc("event_id")])


@query("recent_joined", f"""WITH {LOG_SQL}
SELECT transaction_id, event_id, created_at, decision, c_acctbal, c_mktsegment FROM (
  SELECT * FROM log ORDER BY created_at DESC, event_id DESC LIMIT 100)
LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') ON transaction_id = c_custkey""")
def recent_joined(spark, sf):
    log = prediction_log(spark, sf).select("transaction_id", "event_id", "created_at", "decision")
    right = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("transaction_id"), "c_acctbal", "c_mktsegment")
    return joins.recent_joined(log, right, "transaction_id", [F.desc("created_at"), F.desc("event_id")])


@query("decision_filter", f"""WITH {LOG_SQL}
SELECT event_id, decision FROM log WHERE decision = '{fixed.REVIEW}'""")
def decision_filter(spark, sf):
    return joins.with_decision(prediction_log(spark, sf).select("event_id", "decision"), "fraud", "decision")


@query("children_of_parents", f"""WITH {LOG_SQL}
SELECT transaction_id, event_id, created_at FROM log
WHERE transaction_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def children_of_parents(spark, sf):
    parents = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("transaction_id"))
    log = prediction_log(spark, sf).select("transaction_id", "event_id", "created_at")
    return joins.children_newest_first(parents, log, "transaction_id", [F.desc("created_at"), F.desc("event_id")])


@query("score_once", f"""WITH {LOG_SQL},
stored AS (SELECT * FROM log WHERE model_version = 'view'), requests AS (SELECT * FROM log WHERE model_version <> 'view'),
last AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY created_at DESC, event_id DESC) AS rn FROM stored),
first AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY created_at, event_id) AS rn FROM requests)
SELECT transaction_id, event_id, decision, 'stored' AS source FROM last
WHERE rn = 1 AND transaction_id IN (SELECT transaction_id FROM requests)
UNION ALL
SELECT transaction_id, event_id, decision, 'model' FROM first
WHERE rn = 1 AND transaction_id NOT IN (SELECT transaction_id FROM stored)""")
def score_once(spark, sf):
    log = prediction_log(spark, sf).select("transaction_id", "event_id", "created_at", "decision", "model_version")
    stored = log.where("model_version = 'view'").drop("model_version")
    requests = log.where("model_version <> 'view'").drop("model_version")
    by_time = [F.col("created_at"), F.col("event_id")]
    return predictions.score_once(requests, stored, "transaction_id", by_time, by_time, lambda new: new).drop("created_at")


@query("attach_results", f"""WITH {LOG_SQL}, first AS (
  SELECT transaction_id, decision, row_number() OVER (PARTITION BY transaction_id ORDER BY created_at, event_id) AS rn FROM log)
SELECT log.transaction_id, event_id, first.decision FROM log JOIN first ON log.transaction_id = first.transaction_id AND rn = 1""")
def attach_results(spark, sf):
    log = prediction_log(spark, sf)
    results = predictions.first_by(
        log.select("transaction_id", "created_at", "event_id", "decision"),
        "transaction_id", [F.col("created_at"), F.col("event_id")]).select("transaction_id", "decision")
    return predictions.attach_results(log.select("transaction_id", "event_id"), results, "transaction_id")


@query("append_new_keys", """
SELECT o_custkey AS key, min(o_orderkey) AS o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""")
def append_new_keys(spark, sf):
    batch = table(spark, sf, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    existing = table(spark, sf, "events").select(F.col("user_id").alias("key"))
    return predictions.new_keys(batch, existing, "key", [F.col("o_orderkey")])


@query("prediction_row_types", f"""WITH {LOG_SQL}
SELECT event_id AS transaction_id, 'risk' AS model_name, '1' AS model_version,
       CAST(CAST(fraud_probability AS VARCHAR) AS DECIMAL(12,10)) AS fraud_probability, fraud_prediction, decision,
       0.15::DECIMAL(5,4) AS threshold,
       CAST(CAST(latency_seconds * 1000.0::DOUBLE AS VARCHAR) AS DECIMAL(12,4)) AS prediction_latency_ms, created_at FROM log""")
def prediction_row_types(spark, sf):
    scored = prediction_log(spark, sf).withColumns({
        "threshold": F.lit(0.15), "prediction_latency_ms": F.col("latency_seconds") * 1000.0})
    return predictions.prediction_rows(scored, "risk", "1", key="event_id", created_at=F.col("created_at"))


@query("delete_cascade", """
SELECT 'transactions' AS side, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
UNION ALL
SELECT 'predictions', count(*), sum(l_orderkey)::BIGINT FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def delete_cascade(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    keys = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("key"))
    kept, children = predictions.delete_cascade(
        orders.select(F.col("o_orderkey").alias("key")), lines.select(F.col("l_orderkey").alias("key")), keys, "key")

    def side(name, df):
        return df.agg(F.count("*").alias("n"), F.sum("key").alias("key_sum")).select(F.lit(name).alias("side"), "*")
    return side("transactions", kept).unionByName(side("predictions", children))


@query("stored_delete_cascade", """
SELECT 'transactions' AS side, count(*) AS n, sum(o_orderkey)::BIGINT AS key_sum FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT 'predictions', count(*), sum(o_orderkey)::BIGINT FROM orders
WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'""")
def stored_delete_cascade(spark, sf):
    """Deleted from the stored tables: marked, then taken out of the files that hold them."""
    store = PredictionStore(spark, work_path(spark, "store"))
    orders = table(spark, sf, "orders").withColumns({
        "TransactionID": F.col("o_orderkey"), "TransactionDT": F.lit(0), "TransactionAmt": F.col("o_totalprice"),
        "ProductCD": F.col("o_orderstatus"), "fraud_probability": F.lit(0.5), "fraud_prediction": F.lit(False),
        "decision": F.lit(fixed.LEGITIMATE), "threshold": F.lit(0.6), "prediction_latency_ms": F.lit(None).cast("double")})
    absent = [sent for _, sent in predictions.SENT_AS if sent not in orders.columns]
    full = orders.withColumns({c: F.lit(None).cast("string" if c in ("card4", "card6", "P_emaildomain", "R_emaildomain")
                                                   else "double") for c in absent})
    store.commit(predictions.transaction_rows(full),
                 predictions.prediction_rows(full.where("o_orderpriority <> '5-LOW'"), "risk", "1"), "load", 0)
    store.delete(orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("transaction_id")))
    store.purge()

    def side(name, df):
        return df.agg(F.count("*").alias("n"), F.sum("transaction_id").alias("key_sum")).select(F.lit(name).alias("side"), "*")
    return side("transactions", store.transactions()).unionByName(side("predictions", store.predictions()))


# --- lifetimes ------------------------------------------------------------------------------------

@query("live_entries", """
SELECT event_id, ts + INTERVAL 300 SECOND AS expires_at,
       round(epoch_us(ts + INTERVAL 300 SECOND) / 1000000.0::DOUBLE - epoch_us(TIMESTAMP '2024-01-15 12:00:00') / 1000000.0::DOUBLE, 6) AS remaining_seconds
FROM events WHERE TIMESTAMP '2024-01-15 12:00:00' < ts + INTERVAL 300 SECOND""")
def live_entries(spark, sf):
    entries = predictions.with_expiry(table(spark, sf, "events").select("event_id", "ts"), "ts")
    now = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return rounded(predictions.live_entries(entries, now).drop("ts"), remaining_seconds=6)


def _replay_sql(ttl):
    return f"""
WITH RECURSIVE r AS (
  SELECT event_id, user_id, epoch_ms(ts) AS t,
         row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS rn FROM events),
f AS (
  SELECT event_id, user_id, rn, 'model' AS source, t + {ttl} AS expiry FROM r WHERE rn = 1
  UNION ALL
  SELECT r.event_id, r.user_id, r.rn, CASE WHEN r.t < f.expiry THEN 'cache' ELSE 'database' END,
         CASE WHEN r.t < f.expiry THEN f.expiry ELSE r.t + {ttl} END
  FROM f JOIN r ON r.user_id = f.user_id AND r.rn = f.rn + 1)
SELECT event_id, source FROM f"""


@query("lookup_source_replay", _replay_sql(12 * 3600 * 1000))
def lookup_source_replay(spark, sf):
    requests = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return lifetimes.lookup_sources(requests, "user_id", "ts", "event_id", 12 * 3600).select("event_id", "source")


@query("lookup_source_replay_short", _replay_sql(300 * 1000))
def lookup_source_replay_short(spark, sf):
    requests = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return lifetimes.lookup_sources(requests, "user_id", "ts", "event_id").select("event_id", "source")


@query("lookup_counts", f"SELECT source, count(*) AS total FROM ({_replay_sql(3600 * 1000)}) GROUP BY 1")
def lookup_counts(spark, sf):
    """Lookups by the store that answered them."""
    requests = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return metrics.labelled_counter(
        lifetimes.lookup_sources(requests, "user_id", "ts", "event_id", 3600), "source")


@query("stream_lookup_sources", _replay_sql(12 * 3600 * 1000))
def stream_lookup_sources(spark, sf):
    """The same answers from keyed state in a stream, in four micro-batches by time."""
    at = work_path(spark, "stream-lookups")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    quarter = (F.col("b") - F.col("a")) / 4
    # One row.
    cut = events.join(F.broadcast(span)).withColumn("part", sum(
        (F.col("ts") > F.col("a") + quarter * i).cast("int") for i in (1, 2, 3))).drop("a", "b")
    for part in range(4):
        cut.where(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    rows = lookups.answered(stream, "user_id", "ts", "event_id", 12 * 3600).select("event_id", "source")
    jobs.finish(jobs.to_files(rows, f"{at}/out", f"{at}/checkpoint", available_only=True))
    return spark.read.parquet(f"{at}/out")


# --- metrics --------------------------------------------------------------------------------------

@query("decision_counts", f"WITH {LOG_SQL} SELECT decision, model_version, count(*) AS total FROM log GROUP BY 1, 2")
def decision_counts(spark, sf):
    return metrics.labelled_counter(prediction_log(spark, sf), "decision", "model_version")


def _histogram_sql(value, bounds, by=None):
    listed = ", ".join(f"{b}::DOUBLE" for b in bounds)
    group = f"{by}, " if by else ""
    return f"""WITH {LOG_SQL}, le AS (SELECT unnest([{listed}, 'inf'::DOUBLE]) AS le)
SELECT {group}le, count(*) FILTER ({value} <= le) AS cumulative, count({value}) AS count, round(sum({value}), 4) AS sum
FROM log CROSS JOIN le GROUP BY {group}le"""


@query("risk_histogram", _histogram_sql("fraud_probability", fixed.RISK_SCORE_BOUNDS))
def risk_histogram(spark, sf):
    out = metrics.histogram(prediction_log(spark, sf), "fraud_probability", fixed.RISK_SCORE_BOUNDS)
    return rounded(out, sum=4)


@query("latency_histogram", _histogram_sql("latency_seconds", fixed.INFERENCE_SECONDS_BOUNDS))
def latency_histogram(spark, sf):
    out = metrics.histogram(prediction_log(spark, sf), "latency_seconds", fixed.INFERENCE_SECONDS_BOUNDS)
    return rounded(out, sum=4)


@query("request_histogram", _histogram_sql("latency_seconds", fixed.REQUEST_SECONDS_BOUNDS, "model_version"))
def request_histogram(spark, sf):
    out = metrics.histogram(prediction_log(spark, sf), "latency_seconds", fixed.REQUEST_SECONDS_BOUNDS, ["model_version"])
    return rounded(out, sum=4)


def _quantile_sql(quantiles):
    bounds = fixed.INFERENCE_SECONDS_BOUNDS
    listed = ", ".join(f"{b}::DOUBLE" for b in bounds)
    wanted = ", ".join(f"{q}::DOUBLE" for q in quantiles)
    return f"""WITH {LOG_SQL}, le AS (SELECT unnest([{listed}, 'inf'::DOUBLE]) AS le),
b AS (SELECT le, count(*) FILTER (latency_seconds <= le) AS c, count(latency_seconds) AS n FROM log CROSS JOIN le GROUP BY 1),
p AS (SELECT le, c, n, coalesce(lag(le) OVER (ORDER BY le), 0) AS lo, coalesce(lag(c) OVER (ORDER BY le), 0) AS below FROM b),
q AS (SELECT unnest([{wanted}]) AS quantile)
SELECT quantile, round(min_by(CASE WHEN isinf(le) THEN {bounds[-1]}::DOUBLE
         ELSE lo + (le - lo) * (n * quantile - below) / (c - below) END, le), 6) AS value
FROM q CROSS JOIN p WHERE c >= n * quantile GROUP BY 1"""


@query("histogram_quantiles", _quantile_sql([0.5, 0.95, 0.99]))
def histogram_quantiles(spark, sf):
    out = metrics.histogram_quantiles(
        prediction_log(spark, sf), "latency_seconds", fixed.INFERENCE_SECONDS_BOUNDS, [0.5, 0.95, 0.99])
    return rounded(out, value=6)


@query("rate_per_minute", f"""WITH {LOG_SQL}
SELECT date_trunc('minute', created_at) AS minute, decision, count(*) AS events, round(count(*) / 60.0::DOUBLE, 6) AS per_second
FROM log GROUP BY 1, 2""")
def rate_per_minute(spark, sf):
    return rounded(metrics.rate_per_second(prediction_log(spark, sf), "created_at", ["decision"]), per_second=6)


@query("total_rate_per_minute", f"""WITH {LOG_SQL}
SELECT date_trunc('minute', created_at) AS minute, count(*) AS events, round(count(*) / 60.0::DOUBLE, 6) AS per_second
FROM log GROUP BY 1""")
def total_rate_per_minute(spark, sf):
    return rounded(metrics.rate_per_second(prediction_log(spark, sf), "created_at"), per_second=6)


# Event values as samples of counters that reset often; windows of two hours every hour.
GRID_SQL = """s AS (SELECT event_type, epoch_us(ts) AS us, max(value) AS v FROM events GROUP BY 1, 2),
p AS (SELECT *, lag(v) OVER (PARTITION BY event_type ORDER BY us) AS prior FROM s),
e AS (SELECT epoch_us(date_trunc('hour', min(ts))) AS o, epoch_us(max(ts)) - epoch_us(date_trunc('hour', min(ts))) AS len FROM events),
g AS (SELECT o + 3600000000 * unnest(range(0, len // 3600000000 + 1)) AS step FROM e),
w AS (SELECT step, event_type, count(*) AS n, min(us) AS t0, max(us) AS t1, arg_min(v, us) AS v0, arg_max(v, us) AS v1,
        sum(CASE WHEN v < prior THEN prior ELSE 0 END) - arg_min(CASE WHEN v < prior THEN prior ELSE 0 END, us) AS resets
      FROM g JOIN p ON us > step - 7200000000 AND us <= step GROUP BY 1, 2 HAVING count(*) > 1),
x AS (SELECT *, v1 - v0 + resets AS grown, (t1 - t0)::DOUBLE AS sampled, (t1 - t0)::DOUBLE / (n - 1) AS spacing,
        (t0 - step + 7200000000)::DOUBLE AS head, (step - t1)::DOUBLE AS tail FROM w),
y AS (SELECT *, CASE WHEN head >= 1.1::DOUBLE * spacing THEN spacing / 2 ELSE head END AS h,
        CASE WHEN tail >= 1.1::DOUBLE * spacing THEN spacing / 2 ELSE tail END AS t FROM x),
rates AS (SELECT make_timestamp(step) AS step, event_type, grown * ((sampled + CASE WHEN grown > 0 AND v0 >= 0
        AND sampled * (v0 / grown) < h THEN sampled * (v0 / grown) ELSE h END + t) / sampled) AS increase FROM y)"""


def _sampled_rates(spark, sf):
    events = table(spark, sf, "events").select("event_type", "ts", "value")
    ends = events.agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.max("ts").alias("b")).first()
    kind = events.schema["ts"].dataType
    a, b = (F.lit(t).cast(kind) for t in (ends.a, ends.b))
    return counters.counter_rates(events, "ts", "value", ["event_type"], a, b, 3600, 7200)


@query("counter_rates", f"""WITH {GRID_SQL}
SELECT step, event_type, round(increase, 8) AS increase, round(increase / 7200, 11) AS per_second FROM rates""")
def counter_rates(spark, sf):
    return rounded(_sampled_rates(spark, sf), increase=8, per_second=11)


@query("counter_rate_ratio", f"""WITH {GRID_SQL}
SELECT step, CASE WHEN sum(increase) > 0 THEN round(coalesce(sum(increase) FILTER (event_type = 'view'), 0) / sum(increase), 11)
  ELSE 0.0::DOUBLE END AS ratio FROM rates GROUP BY 1""")
def counter_rate_ratio(spark, sf):
    """Share of one label in the summed rates."""
    return rounded(counters.rate_ratio(_sampled_rates(spark, sf), F.col("event_type") == "view"), ratio=11)


@query("counter_rates_summed", f"""WITH {GRID_SQL}
SELECT step, round(sum(increase / 7200), 11) AS per_second FROM rates GROUP BY 1""")
def counter_rates_summed(spark, sf):
    return rounded(counters.summed_rates(_sampled_rates(spark, sf)), per_second=11)


@query("hit_ratio", f"""WITH {LOG_SQL}
SELECT date_trunc('minute', created_at) AS minute, count(*) FILTER (model_version = 'view') AS hits, count(*) AS lookups,
       round(count(*) FILTER (model_version = 'view') / count(*), 6) AS hit_ratio FROM log GROUP BY 1""")
def hit_ratio(spark, sf):
    out = metrics.hit_ratio(prediction_log(spark, sf), "created_at", F.col("model_version") == "view")
    return rounded(out, hit_ratio=6)


@query("flagged_total", f"WITH {LOG_SQL} SELECT count(*) FILTER (decision = '{fixed.REVIEW}') AS flagged FROM log")
def flagged_total(spark, sf):
    return metrics.flagged_total(prediction_log(spark, sf))


@query("dashboard_kpis", f"""WITH {LOG_SQL}
SELECT count(*) AS total, count(*) FILTER (fraud_prediction) AS flagged,
       round(count(*) FILTER (fraud_prediction) * 100.0::DOUBLE / count(*), 6) AS flagged_percentage,
       round(avg(latency_seconds * 1000.0::DOUBLE), 4) AS mean_latency_ms FROM log""")
def dashboard_kpis(spark, sf):
    log = prediction_log(spark, sf).withColumn("prediction_latency_ms", F.col("latency_seconds") * 1000.0)
    return rounded(metrics.kpis(log), flagged_percentage=6, mean_latency_ms=4)


@query("run_summary", f"""WITH {LOG_SQL}
SELECT count(*) AS sent, count(*) FILTER (contains(lower(decision), 'fraud')) AS flagged,
       count(*) FILTER (NOT contains(lower(decision), 'fraud')) AS legitimate,
       round(count(*) FILTER (contains(lower(decision), 'fraud')) * 100.0::DOUBLE / count(*), 6) AS flagged_percentage
FROM log""")
def run_summary(spark, sf):
    return rounded(metrics.run_summary(prediction_log(spark, sf)), flagged_percentage=6)
