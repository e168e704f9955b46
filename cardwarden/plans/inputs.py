"""The given tables seen as card transactions.

Each view comes as a DataFrame function and as the SQL the oracles start from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions.clock import SECOND, epoch_micros, whole_units
from cardwarden.functions.decision import decision, flagged
from cardwarden.operators.joins import join_one_to_one
from cardwarden.plans.catalog import table
from cardwarden.session import BROADCAST_ROWS


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """documents ⟕ labels: a table with a partly covering companion."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return join_one_to_one(docs, table(spark, sf, "labels"), "doc_id", flag="has_label")


LABELLED_SQL = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, l.doc_id IS NOT NULL AS has_label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def gappy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with missing values and a 0/1 target."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_extendedprice").alias("TransactionAmt"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 25), None)
        .otherwise(F.col("l_quantity")).alias("C1"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("V1"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("V2"),
        F.when(F.col("l_linenumber") != 7, F.col("l_linestatus")).alias("M1"),
        (F.col("l_returnflag") == "R").cast("int").alias("isFraud"),
    )


GAPPY_COLUMNS = ["TransactionAmt", "C1", "V1", "V2", "M1"]
GAPPY_SQL = """gappy AS (
  SELECT l_extendedprice AS TransactionAmt,
         CASE WHEN l_linestatus = 'O' AND l_quantity > 25 THEN NULL ELSE l_quantity END AS C1,
         nullif(l_discount, 0.0::DOUBLE) AS V1, nullif(l_tax, 0.0::DOUBLE) AS V2,
         CASE WHEN l_linenumber <> 7 THEN l_linestatus END AS M1,
         (l_returnflag = 'R')::INTEGER AS isFraud
  FROM lineitem)"""


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with a score full of ties and a 0/1 label."""
    li = table(spark, sf, "lineitem")
    return li.select(
        (F.round(F.col("l_discount") * 100) / 10.0).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


SCORED_SQL = """scored AS (
  SELECT round(l_discount * 100) / 10.0::DOUBLE AS score, (l_returnflag = 'R')::INTEGER AS label
  FROM lineitem)"""


def priced_lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with a nearly continuous score."""
    li = table(spark, sf, "lineitem")
    return li.select(
        (F.col("l_extendedprice") / 110000.0).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"))


PRICED_SQL = """scored AS (
  SELECT l_extendedprice / 110000.0::DOUBLE AS score, (l_returnflag = 'R')::INTEGER AS label
  FROM lineitem)"""


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """events as a prediction log: one prediction per event, keyed by the user."""
    p = F.col("value") / 500.0
    return table(spark, sf, "events").select(
        F.col("event_id"), F.col("user_id").alias("transaction_id"), F.col("ts").alias("created_at"),
        F.col("event_type").alias("model_version"),
        p.alias("fraud_probability"), flagged(p, 0.15).alias("fraud_prediction"),
        decision(p, 0.15).alias("decision"),
        (F.get_json_object("props", "$.k").cast("double") / 200.0).alias("latency_seconds"),
    )


LOG_SQL = f"""log AS (
  SELECT event_id, user_id AS transaction_id, ts AS created_at, event_type AS model_version,
         value / 500.0::DOUBLE AS fraud_probability,
         value / 500.0::DOUBLE >= 0.15::DOUBLE AS fraud_prediction,
         CASE WHEN value / 500.0::DOUBLE >= 0.15::DOUBLE THEN '{fixed.REVIEW}'
              ELSE '{fixed.LEGITIMATE}' END AS decision,
         json_extract_string(props, '$.k')::DOUBLE / 200.0::DOUBLE AS latency_seconds
  FROM events)"""


def card_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """orders with customer and line facts as a wide transaction table with a target."""
    orders = table(spark, sf, "orders")
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("TransactionID")).agg(
        F.count("*").cast("double").alias("C1"),
        F.avg("l_discount").alias("V1"), F.max("l_quantity").alias("V2"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"))
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("card1"), F.col("c_nationkey").cast("double").alias("addr1"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("dist1"),
        F.col("c_mktsegment").alias("card6"))
    if customer.count() <= BROADCAST_ROWS:
        customer = F.broadcast(customer)
    base = orders.select(
        F.col("o_orderkey").alias("TransactionID"),
        whole_units(epoch_micros(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType), SECOND).alias("TransactionDT"),
        F.col("o_totalprice").alias("TransactionAmt"), F.col("o_orderstatus").alias("ProductCD"),
        F.col("o_custkey").alias("card1"), F.substring("o_orderpriority", 3, 20).alias("card4"))
    return (
        base.join(customer, "card1", "left").join(lines, "TransactionID", "left")
        .select("TransactionID", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card4", "card6",
                "addr1", "dist1", "C1", "V1", "V2",
                F.coalesce("returned", F.lit(0)).alias("isFraud"))
    )


CARD_SQL = """card AS (
  SELECT o_orderkey AS TransactionID, epoch(o_orderdate)::BIGINT AS TransactionDT,
         o_totalprice AS TransactionAmt, o_orderstatus AS ProductCD, o_custkey AS card1,
         substring(o_orderpriority, 3, 20) AS card4, c_mktsegment AS card6,
         c_nationkey::DOUBLE AS addr1, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS dist1,
         C1, V1, V2, coalesce(returned, 0) AS isFraud
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN (SELECT l_orderkey, count(*)::DOUBLE AS C1, avg(l_discount) AS V1, max(l_quantity) AS V2,
                    max((l_returnflag = 'R')::INTEGER) AS returned FROM lineitem GROUP BY 1)
       ON o_orderkey = l_orderkey)"""
