"""Catalogue: JSON messages and streaming jobs over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed
from cardwarden.functions import text
from cardwarden.functions.clock import SECOND, epoch_micros, whole_units
from cardwarden.functions.decision import decision, flagged
from cardwarden.operators.validation import accepted, with_reasons
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.schemas import TRANSACTION
from cardwarden.session import work_path
from cardwarden.sinks.bus import as_messages
from cardwarden.sources.tables import table_stream
from cardwarden.streaming import jobs
from cardwarden.streaming.parse import parse_records, parse_with_extras
from cardwarden.streaming.score_once import score_batch
from cardwarden.streaming.store import PredictionStore

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def event_stream(spark, sf):
    """The events table, one file or a folder of part files, as a stream of files."""
    return table_stream(spark, sf, "events.parquet", EVENTS)


def bus_records(events, payload):
    """Events as bus records with the given payload columns."""
    return events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        text.compact_json(*payload).cast("binary").alias("value"),
        F.lit("transactions").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))


def _seconds():
    return whole_units(epoch_micros(F.col("ts"), T.TimestampNTZType()), SECOND)


def payload():
    """One transaction per event; whole numbers in card1 are sent as ``n.0``."""
    return [F.col("event_id").alias("TransactionID"), _seconds().alias("TransactionDT"),
            F.col("value").alias("TransactionAmt"), F.col("event_type").alias("ProductCD"),
            F.col("user_id").cast("double").alias("card1"),
            F.get_json_object("props", "$.k").alias("k")]


PARSED_SQL = """
SELECT event_id AS TransactionID, floor(epoch_us(ts) / 1000000)::BIGINT AS TransactionDT, value AS TransactionAmt,
       event_type AS ProductCD, user_id AS card1, NULL::VARCHAR AS card4, 'transactions' AS topic,
       (user_id % 3)::INTEGER AS "partition", event_id AS "offset" FROM events"""
PARSED_COLUMNS = ["TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card4",
                  "topic", "partition", "offset"]


@query("json_parse", PARSED_SQL)
def json_parse(spark, sf):
    return parse_records(bus_records(table(spark, sf, "events"), payload())).select(*PARSED_COLUMNS)


@query("json_extras", """
SELECT event_id AS TransactionID, json_extract_string(props, '$.k') AS extra_k, 1::INTEGER AS n_extras FROM events""")
def json_extras(spark, sf):
    rows = parse_with_extras(bus_records(table(spark, sf, "events"), payload()))
    return rows.select("TransactionID", F.col("extras")["k"].alias("extra_k"), F.size("extras").alias("n_extras"))


def _faulty_payload():
    """Some event types leave a required field out or send one that cannot be read."""
    kind = F.col("event_type")
    return [F.when(kind != "signup", F.col("event_id")).alias("TransactionID"),
            F.when(~kind.isin("error", "signup"), _seconds()).alias("TransactionDT"),
            F.when(kind == "view", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("TransactionAmt"),
            F.when(kind == "click", F.lit("unknown")).otherwise(F.col("user_id").cast("string")).alias("addr1")]


@query("json_validate", """
WITH v AS (SELECT event_id AS "offset", CASE event_type
  WHEN 'signup' THEN 'missing:TransactionID,missing:TransactionDT' WHEN 'error' THEN 'missing:TransactionDT'
  WHEN 'view' THEN 'type:TransactionAmt' WHEN 'click' THEN 'type:addr1' ELSE '' END AS reasons FROM events)
SELECT "offset", reasons, reasons = '' AS accepted FROM v""")
def json_validate(spark, sf):
    rows = parse_with_extras(bus_records(table(spark, sf, "events"), _faulty_payload()))
    return with_reasons(rows, TRANSACTION).select(
        "offset", F.array_join("reasons", ",").alias("reasons"), (F.size("reasons") == 0).alias("accepted"))


@query("accepted_requests", """
SELECT event_id AS TransactionID, floor(epoch_us(ts) / 1000000)::BIGINT AS TransactionDT, value AS TransactionAmt
FROM events WHERE event_type NOT IN ('signup', 'error', 'view', 'click')""")
def accepted_requests(spark, sf):
    rows = parse_with_extras(bus_records(table(spark, sf, "events"), _faulty_payload()))
    return accepted(with_reasons(rows, TRANSACTION)).select("TransactionID", "TransactionDT", "TransactionAmt")


@query("json_publish", """
SELECT c_custkey::VARCHAR AS key, c_custkey, c_name, c_acctbal,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment, true AS segment_sent FROM customer""")
def json_publish(spark, sf):
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment"))
    sent = as_messages(customer, "c_custkey")
    back = "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string"
    return sent.select("key", F.from_json("value", back).alias("r"),
                       F.col("value").contains('"c_mktsegment":').alias("segment_sent")).select(
        "key", "r.*", "segment_sent")


@query("compact_entries", f"""
SELECT '{fixed.STORE_KEY_PREFIX}' || c_custkey::VARCHAR AS key,
       '{{"transaction_id":' || c_custkey::VARCHAR || ',"decision":"' || c_mktsegment || '","model":null}}' AS entry FROM customer""")
def compact_entries(spark, sf):
    return table(spark, sf, "customer").select(
        text.store_key(F.col("c_custkey")).alias("key"),
        text.compact_json(F.col("c_custkey").alias("transaction_id"), F.col("c_mktsegment").alias("decision"),
                          F.lit(None).cast("string").alias("model")).alias("entry"))


# --- streams --------------------------------------------------------------------------------------

@query("stream_parse", PARSED_SQL)
def stream_parse(spark, sf):
    at = work_path(spark, "stream-parse")
    rows = parse_records(bus_records(event_stream(spark, sf), payload()))
    jobs.finish(jobs.to_files(rows, f"{at}/rows", f"{at}/checkpoint", available_only=True))
    return spark.read.parquet(f"{at}/rows").select(*PARSED_COLUMNS)


@query("stream_rates", """
SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS events FROM events GROUP BY 1, 2""")
def stream_rates(spark, sf):
    at = work_path(spark, "stream-rates")
    counts = jobs.windowed_counts(event_stream(spark, sf), "ts", ["event_type"], late_by=None)
    jobs.finish(jobs.to_latest_windows(counts, f"{at}/rows", f"{at}/checkpoint", available_only=True))
    stored = spark.read.parquet(f"{at}/rows").withColumn("minute", F.col("minute").cast("timestamp_ntz"))
    return jobs.latest_windows(stored, ["minute", "event_type"])


def _user_payload():
    return [F.col("user_id").alias("TransactionID"), _seconds().alias("TransactionDT"),
            F.col("value").alias("TransactionAmt"), F.col("event_type").alias("ProductCD")]


def amount_score(rows):
    """A stand-in scorer: the amount as a probability."""
    p = F.col("TransactionAmt") / 500.0
    return rows.withColumns({"fraud_probability": p, "fraud_prediction": flagged(p, 0.15),
                             "decision": decision(p, 0.15), "threshold": F.lit(0.15)})


@query("stream_score_once", f"""
WITH f AS (SELECT user_id, value / 500.0::DOUBLE AS p, event_type, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT user_id AS transaction_id, CAST(CAST(p AS VARCHAR) AS DECIMAL(12,10)) AS fraud_probability,
       p >= 0.15::DOUBLE AS fraud_prediction, CASE WHEN p >= 0.15::DOUBLE THEN '{fixed.REVIEW}' ELSE '{fixed.LEGITIMATE}' END AS decision,
       event_type AS product_cd, floor(epoch_us(ts) / 1000000)::BIGINT AS transaction_dt FROM f WHERE rn = 1""")
def stream_score_once(spark, sf):
    at = work_path(spark, "stream-score")
    store = PredictionStore(spark, f"{at}/store")
    handler = score_batch(store, amount_score, "amount", "1", [F.col("offset")], f"{at}/rejects")
    records = bus_records(event_stream(spark, sf), _user_payload())
    jobs.finish(jobs.each_batch(records, handler, f"{at}/checkpoint", available_only=True))
    left = store.predictions().select("transaction_id", "fraud_probability", "fraud_prediction", "decision")
    return left.join(store.transactions().select("transaction_id", "product_cd", "transaction_dt"), "transaction_id")


@query("stream_rejects", """
SELECT event_id AS "offset", CASE event_type
  WHEN 'signup' THEN 'missing:TransactionID,missing:TransactionDT' WHEN 'error' THEN 'missing:TransactionDT'
  WHEN 'view' THEN 'type:TransactionAmt' ELSE 'type:addr1' END AS reasons
FROM events WHERE event_type IN ('signup', 'error', 'view', 'click')""")
def stream_rejects(spark, sf):
    """What the scoring stream turned away, none lost."""
    at = work_path(spark, "stream-rejects")
    handler = score_batch(PredictionStore(spark, f"{at}/store"), amount_score, "amount", "1", [F.col("offset")], f"{at}/rejects")
    records = bus_records(event_stream(spark, sf), _faulty_payload())
    jobs.finish(jobs.each_batch(records, handler, f"{at}/checkpoint", available_only=True))
    return spark.read.parquet(f"{at}/rejects").select("offset", F.array_join("reasons", ",").alias("reasons"))


@query("stream_first_within_horizon", """
SELECT user_id, 1::BIGINT AS n, CASE WHEN count(*) = 1 THEN min(event_id) END AS only_event FROM events GROUP BY 1""")
def stream_first_within_horizon(spark, sf):
    """One row per user inside the horizon; which one is certain for users seen once."""
    at = work_path(spark, "stream-dedupe")
    horizon = jobs.span_of(table(spark, sf, "events"), "ts", 60)
    rows = jobs.dedupe_within(event_stream(spark, sf), "user_id", "ts", horizon).select("user_id", "event_id")
    jobs.finish(jobs.to_files(rows, f"{at}/rows", f"{at}/checkpoint", available_only=True))
    seen = table(spark, sf, "events").groupBy("user_id").agg(F.count("*").alias("seen"))
    return spark.read.parquet(f"{at}/rows").join(seen, "user_id").groupBy("user_id").agg(
        F.count("*").alias("n"), F.min(F.when(F.col("seen") == 1, F.col("event_id"))).alias("only_event"))
