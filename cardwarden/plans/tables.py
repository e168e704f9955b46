"""Catalogue: sources, sinks, joins, keys, quality and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.functions import numeric, text
from cardwarden.operators import joins, missingness, ordering, quality
from cardwarden.operators.running import RunningProfile
from cardwarden.plans.catalog import query, rounded, table
from cardwarden.plans.inputs import (
    GAPPY_COLUMNS, GAPPY_SQL, LABELLED_SQL, LOG_SQL, gappy_lines, labelled_documents, prediction_log)
from cardwarden.schemas import DOUBLE, LONG, TEXT, conform, schema_of
from cardwarden.session import work_path
from cardwarden.sinks.tables import export_csv, write_table
from cardwarden.sources.tables import read_csv

ORDERS_CSV = schema_of(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=TEXT, o_totalprice=DOUBLE, o_orderpriority=TEXT)


@query("csv_round_trip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def csv_round_trip(spark, sf):
    path = work_path(spark, "orders-csv")
    export_csv(table(spark, sf, "orders").select(*ORDERS_CSV.names), path)
    return read_csv(spark, path, ORDERS_CSV)


@query("parquet_partitioned_round_trip", """
SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1""")
def parquet_partitioned_round_trip(spark, sf):
    path = work_path(spark, "orders-by-status")
    write_table(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"),
                path, ["o_orderstatus"])
    back = spark.read.parquet(path)
    return back.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("pruned_scan", "SELECT o_orderdate, o_totalprice FROM orders WHERE o_totalprice >= 250000")
def pruned_scan(spark, sf):
    return table(spark, sf, "orders").select("o_orderdate", "o_totalprice").where("o_totalprice >= 250000")


@query("first_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def first_rows(spark, sf):
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(5)


@query("lookup_by_key", "SELECT * FROM orders WHERE o_orderkey = 42")
def lookup_by_key(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderkey") == 42)


@query("search_by_id_text", "SELECT o_orderkey, o_totalprice FROM orders WHERE regexp_matches(o_orderkey::VARCHAR, '^1[0-4]+7')")
def search_by_id_text(spark, sf):
    return table(spark, sf, "orders").where(text.id_matches(F.col("o_orderkey"), "^1[0-4]+7")).select(
        "o_orderkey", "o_totalprice")


# --- joins and keys -------------------------------------------------------------------------------

@query("left_join_one_to_one", f"WITH {LABELLED_SQL} SELECT * FROM labelled")
def left_join_one_to_one(spark, sf):
    return labelled_documents(spark, sf)


@query("join_coverage", f"""WITH {LABELLED_SQL}
SELECT count(*) AS total_rows, count(*) FILTER (has_label) AS matched,
       count(*) FILTER (NOT has_label) AS unmatched,
       round(count(*) FILTER (has_label) * 100.0::DOUBLE / count(*), 6) AS coverage FROM labelled""")
def join_coverage(spark, sf):
    return rounded(joins.join_coverage(labelled_documents(spark, sf), "has_label"), coverage=6)


@query("key_coverage", """
WITH k AS (SELECT DISTINCT doc_id FROM documents)
SELECT count(*) AS total_keys, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS matched_keys,
       round(count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) * 100.0::DOUBLE / count(*), 6) AS coverage FROM k""")
def key_coverage(spark, sf):
    out = quality.key_coverage(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")
    return rounded(out, coverage=6)


@query("common_keys", "SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels")
def common_keys(spark, sf):
    return quality.common_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@query("orphan_keys", """
SELECT user_id, count(*) AS n FROM events
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = user_id) GROUP BY 1""")
def orphan_keys(spark, sf):
    return quality.orphan_keys(table(spark, sf, "events"), "user_id", table(spark, sf, "supplier"), "s_suppkey")


@query("key_profile", """
SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""")
def key_profile(spark, sf):
    return quality.key_profile(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("duplicate_keys", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("drop_duplicate_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def drop_duplicate_rows(spark, sf):
    return quality.drop_exact_duplicates(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


@query("removed_duplicates", """
WITH d AS (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS rows_before, (SELECT count(*) FROM d) AS rows_after,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM d) AS removed""")
def removed_duplicates(spark, sf):
    return quality.removed_duplicates(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


# --- profiles -------------------------------------------------------------------------------------

@query("id_range", "SELECT min(o_orderkey) AS min_o_orderkey, max(o_orderkey) AS max_o_orderkey FROM orders")
def id_range(spark, sf):
    return quality.value_range(table(spark, sf, "orders"), "o_orderkey")


@query("time_range", "SELECT min(o_orderdate) AS min_o_orderdate, max(o_orderdate) AS max_o_orderdate FROM orders")
def time_range(spark, sf):
    return quality.value_range(table(spark, sf, "orders"), "o_orderdate")


@query("amount_profile", """
SELECT min(c_acctbal) AS minimum, max(c_acctbal) AS maximum, round(avg(c_acctbal), 4) AS mean,
       count(c_acctbal) AS amounts, count(*) FILTER (c_acctbal <= 0) AS zero_or_negative FROM customer""")
def amount_profile(spark, sf):
    return rounded(quality.amount_profile(table(spark, sf, "customer"), "c_acctbal"), mean=4)


@query("target_distribution", """
SELECT toxic, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 6) AS percentage
FROM labels GROUP BY 1""")
def target_distribution(spark, sf):
    return rounded(quality.value_counts(table(spark, sf, "labels"), "toxic"), percentage=6)


@query("value_counts", """
SELECT event_type, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 6) AS percentage
FROM events GROUP BY 1""")
def value_counts(spark, sf):
    return rounded(quality.value_counts(table(spark, sf, "events"), "event_type"), percentage=6)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
DISTINCT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM orders" for c in ORDER_COLUMNS)


@query("distinct_per_column", DISTINCT_SQL)
def distinct_per_column(spark, sf):
    return quality.distinct_per_column(table(spark, sf, "orders"))


@query("high_cardinality", f"SELECT * FROM ({DISTINCT_SQL}) WHERE distinct_values > 1000")
def high_cardinality(spark, sf):
    return quality.high_cardinality(table(spark, sf, "orders"))


@query("range_check", f"""WITH {LOG_SQL}
SELECT count(*) AS total_rows, count(*) FILTER (NOT coalesce(fraud_probability BETWEEN 0 AND 1, false)) AS out_of_range
FROM log""")
def range_check(spark, sf):
    return quality.range_check(prediction_log(spark, sf), "fraud_probability")


@query("golden_check", """
WITH want AS (SELECT o_custkey, avg(o_totalprice) AS v FROM orders GROUP BY 1),
     got AS (SELECT c_custkey, round(v, 2) + CASE WHEN c_nationkey = 3 THEN 0.5 ELSE 0 END AS v
             FROM want JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING')
SELECT count(*) AS expected_rows, count(c_custkey) AS found,
       count(*) FILTER (NOT coalesce(abs(got.v - want.v) <= 0.01, false)) AS mismatches
FROM want LEFT JOIN got ON o_custkey = c_custkey""")
def golden_check(spark, sf):
    want = table(spark, sf, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("v"))
    customer = table(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'")
    got = want.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_custkey", (F.round("v", 2) + F.when(F.col("c_nationkey") == 3, 0.5).otherwise(0.0)).alias("v"))
    return quality.golden_check(got, want, "o_custkey", "v", 0.01)


# --- missing values -------------------------------------------------------------------------------

def _missing_sql(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_percentage FROM {source}"
        for c in columns)


LABELLED_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@query("missing_rate_by_column", f"WITH {LABELLED_SQL} {_missing_sql(LABELLED_COLUMNS, 'labelled')}")
def missing_rate_by_column(spark, sf):
    out = missingness.missing_profile(labelled_documents(spark, sf), LABELLED_COLUMNS)
    return rounded(out, missing_percentage=6)


@query("most_missing_columns", f"""WITH {GAPPY_SQL}
SELECT * FROM ({_missing_sql(GAPPY_COLUMNS, 'gappy')}) ORDER BY missing_percentage DESC, "column" LIMIT 3""")
def most_missing_columns(spark, sf):
    return rounded(missingness.most_missing(gappy_lines(spark, sf), GAPPY_COLUMNS, 3), missing_percentage=6)


@query("missing_indicators", f"""WITH {GAPPY_SQL}
SELECT V1_missing, V2_missing, C1_missing, count(*) AS n FROM (
  SELECT (V1 IS NULL)::TINYINT AS V1_missing, (V2 IS NULL)::TINYINT AS V2_missing,
         (C1 IS NULL)::TINYINT AS C1_missing FROM gappy) GROUP BY ALL""")
def missing_indicators(spark, sf):
    flagged = missingness.add_indicators(gappy_lines(spark, sf), ["V1", "V2", "C1"])
    return flagged.groupBy("V1_missing", "V2_missing", "C1_missing").agg(F.count("*").alias("n"))


_N_MISSING = " + ".join(f"({c} IS NULL)::INTEGER" for c in GAPPY_COLUMNS)


@query("target_rate_by_missing_count", f"""WITH {GAPPY_SQL}
SELECT {_N_MISSING} AS missing_count, count(isFraud) AS transactions, sum(isFraud)::BIGINT AS fraud_count,
       round(avg(isFraud), 6) AS fraud_rate FROM gappy GROUP BY 1 HAVING count(isFraud) >= 100""")
def target_rate_by_missing_count(spark, sf):
    return rounded(missingness.rate_by_missing_count(gappy_lines(spark, sf), GAPPY_COLUMNS, fixed.TARGET),
                   fraud_rate=6)


@query("target_rate_by_v_missing_count", f"""WITH {GAPPY_SQL}
SELECT (V1 IS NULL)::INTEGER + (V2 IS NULL)::INTEGER AS v_missing, count(isFraud) AS transactions,
       sum(isFraud)::BIGINT AS fraud_count, round(avg(isFraud), 6) AS fraud_rate
FROM gappy GROUP BY 1 HAVING count(isFraud) >= 100""")
def target_rate_by_v_missing_count(spark, sf):
    out = missingness.rate_by_missing_count(
        gappy_lines(spark, sf), ["V1", "V2"], fixed.TARGET, name="v_missing")
    return rounded(out, fraud_rate=6)


@query("label_rate_by_missing_count", f"""WITH {LABELLED_SQL}
SELECT (quality IS NULL)::INTEGER + (toxic IS NULL)::INTEGER AS missing_count, count(toxic) AS transactions,
       sum(toxic)::BIGINT AS fraud_count, round(avg(toxic), 6) AS fraud_rate
FROM labelled GROUP BY 1 HAVING count(toxic) >= 100""")
def label_rate_by_missing_count(spark, sf):
    out = missingness.rate_by_missing_count(labelled_documents(spark, sf), ["quality", "toxic"], "toxic")
    return rounded(out, fraud_rate=6)


@query("target_rate_missing_vs_present", f"WITH {GAPPY_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing_count,
        round(count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*), 6) AS missing_percentage,
        round(coalesce(avg(isFraud) FILTER ({c} IS NULL), 0), 6) AS rate_missing,
        round(coalesce(avg(isFraud) FILTER ({c} IS NOT NULL), 0), 6) AS rate_present FROM gappy"""
    for c in GAPPY_COLUMNS))
def target_rate_missing_vs_present(spark, sf):
    out = missingness.rate_missing_vs_present(gappy_lines(spark, sf), GAPPY_COLUMNS, fixed.TARGET)
    return rounded(out, missing_percentage=6, rate_missing=6, rate_present=6)


def _describe_sql(columns, probs, source):
    points = ", ".join(
        f"round(quantile_cont({{c}}, {p}), 6) AS p{round(p * 100):02d}" for p in probs)
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, {points.format(c=c)}
        FROM {source}""" for c in columns)


def _described(df, columns, probs):
    points = {f"p{round(p * 100):02d}": 6 for p in probs}
    return rounded(missingness.describe(df, columns, probs), mean=4, std=4, **points)


@query("describe_summary", _describe_sql(["o_totalprice"], fixed.DESCRIBE_PROBS, "orders"))
def describe_summary(spark, sf):
    return _described(table(spark, sf, "orders"), ["o_totalprice"], fixed.DESCRIBE_PROBS)


@query("describe_percentiles", f"WITH {GAPPY_SQL} " + _describe_sql(
    ["TransactionAmt", "C1", "V1", "V2"], fixed.WIDE_PROBS, "gappy"))
def describe_percentiles(spark, sf):
    return _described(gappy_lines(spark, sf), ["TransactionAmt", "C1", "V1", "V2"], fixed.WIDE_PROBS)


@query("describe_missing_counts", f"""WITH {GAPPY_SQL}, counts AS (SELECT {_N_MISSING} AS missing_count FROM gappy)
{_describe_sql(["missing_count"], fixed.DESCRIBE_PROBS, "counts")}""")
def describe_missing_counts(spark, sf):
    counts = gappy_lines(spark, sf).select(numeric.missing_count(GAPPY_COLUMNS).alias("missing_count"))
    return _described(counts, ["missing_count"], fixed.DESCRIBE_PROBS)


# --- conversions ----------------------------------------------------------------------------------

@query("schema_conformance", """
SELECT o_orderkey AS TransactionID, NULL::DOUBLE AS TransactionAmt, o_orderstatus AS ProductCD,
       o_custkey::DOUBLE AS card1, NULL::VARCHAR AS card4 FROM orders""")
def schema_conformance(spark, sf):
    given = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("TransactionID"), F.col("o_custkey").alias("card1"),
        F.col("o_orderstatus").alias("ProductCD"), "o_orderpriority")
    return conform(given, schema_of(TransactionAmt=DOUBLE, ProductCD=TEXT, card1=DOUBLE, card4=TEXT),
                   keep=["TransactionID"])


@query("numeric_conversions", """
SELECT c_custkey, CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(18,6)) AS amount, trunc(c_acctbal)::BIGINT AS whole,
       round_even(c_acctbal / 7.0::DOUBLE, 4) AS seventh, 'fraud:risk:' || c_custkey::VARCHAR AS store_key,
       coalesce(CASE WHEN c_acctbal > 0 THEN c_acctbal END, 0.0::DOUBLE) AS with_default,
       abs(c_acctbal) AS magnitude,
       CASE WHEN c_acctbal > 0 THEN 'toward_fraud' ELSE 'toward_legitimate' END AS direction,
       contains(lower(c_mktsegment), 'build') AS building FROM customer""")
def numeric_conversions(spark, sf):
    from cardwarden.functions.decision import direction
    bal = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey", numeric.exact_decimal(bal, 18, 6).alias("amount"), numeric.whole(bal).alias("whole"),
        numeric.half_even(bal / 7.0).alias("seventh"), text.store_key(F.col("c_custkey")).alias("store_key"),
        F.coalesce(F.when(bal > 0, bal), F.lit(0.0)).alias("with_default"), F.abs(bal).alias("magnitude"),
        direction(bal).alias("direction"),
        text.contains_ignoring_case(F.col("c_mktsegment"), "Build").alias("building"))


@query("nan_to_null", """
SELECT l_orderkey, l_linenumber, count(*) AS n, count(nullif(l_discount, 0)) AS present FROM lineitem GROUP BY 1, 2""")
def nan_to_null(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(
        F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_discount")).alias("d"))
    return numeric.nan_to_null(li).groupBy("l_orderkey", "l_linenumber").agg(
        F.count("*").alias("n"), F.count("d").alias("present"))


@query("exact_order_statistics", """
SELECT round(median(l_extendedprice), 6) AS median_price, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999_price
FROM lineitem""")
def exact_order_statistics(spark, sf):
    li = table(spark, sf, "lineitem")
    mid, high = ordering.exact_quantiles(li, ["l_extendedprice"], [0.5, 0.999])["l_extendedprice"]
    return li.limit(1).select(F.round(F.lit(mid), 6).alias("median_price"), F.round(F.lit(high), 6).alias("p999_price"))


@query("running_profile", """
SELECT count(*) AS total_rows, count(*) FILTER (l_orderkey IS NULL) AS missing_keys, count(DISTINCT l_orderkey) AS distinct_keys,
       count(l_orderkey) - count(DISTINCT l_orderkey) AS duplicates, min(l_orderkey) AS min_key, max(l_orderkey) AS max_key,
       min(l_linenumber)::BIGINT AS min_time, max(l_linenumber)::BIGINT AS max_time, min(l_extendedprice) AS minimum, max(l_extendedprice) AS maximum,
       round(avg(l_extendedprice), 4) AS mean, count(l_extendedprice) AS amounts, count(*) FILTER (l_extendedprice <= 0) AS zero_or_negative,
       count(*) FILTER (l_returnflag = 'R') AS positives, count(*) FILTER (l_returnflag <> 'R') AS negatives FROM lineitem""")
def running_profile(spark, sf):
    """A profile taken over files as they arrive: three runs, each of which reads the new files alone."""
    at = work_path(spark, "running")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("returned"))
    profile = RunningProfile(spark, f"{at}/profile", "l_orderkey", "l_linenumber", "l_extendedprice", "returned")
    for run in range(3):
        lines.where(F.pmod(F.xxhash64(*lines.columns), F.lit(3)) == run).write.mode("append").parquet(f"{at}/lines")
        source = spark.read.schema(lines.schema).parquet(f"{at}/lines")
        profile.update(source.inputFiles(), lambda files: spark.read.schema(lines.schema).parquet(*files))
    return rounded(profile.report(), mean=4)
