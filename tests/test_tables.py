import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwarden import fixed, schemas
from cardwarden.functions import numeric, text
from cardwarden.operators import joins, missingness, quality
from cardwarden.session import work_path
from cardwarden.sinks.bus import as_messages
from cardwarden.sinks.tables import export_csv, write_bucketed
from cardwarden.sources import bus, tables


def test_csv_edge(spark):
    schema = T.StructType.fromDDL("id bigint, x double, s string")
    path = work_path(spark, "csv")
    export_csv(spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, None)], schema), path)
    rows = {r.id: (r.x, r.s) for r in tables.read_csv(spark, path, schema).collect()}
    assert rows == {1: (None, "a"), 2: (1.5, None)}
    with pytest.raises(AnalysisException):
        tables.read_csv(spark, path + "-absent", schema).count()
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tables.read_csv(spark, path, T.StructType.fromDDL("id bigint, x double, s bigint")).collect()


def test_inspect(spark):
    path = work_path(spark, "inspect")
    spark.range(20).write.parquet(path)
    parts = tables.inspect(spark.read.parquet(path), "id")
    assert [r.id for r in parts["sample"].collect()] == [0, 1, 2, 3, 4]
    assert parts["columns"].first().column == "id" and parts["files"].agg(F.sum("bytes")).first()[0] > 0


def test_bus_options():
    o = bus.bus_options("h:1", "topic", 500, kafka__group__id="g")
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["maxOffsetsPerTrigger"] == "500" and o["kafka.group.id"] == "g"


def test_messages_keep_nulls(spark):
    df = spark.createDataFrame([(7, float("nan"), None)], "TransactionID bigint, x double, s string")
    assert tuple(as_messages(df).first()) == ("7", '{"TransactionID":7,"x":null,"s":null}')


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("bucketed_left", "bucketed_right"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        write_bucketed(spark.range(100).withColumn("v", F.lit(name)), name, "id", 4)
    try:
        left, right = spark.table("bucketed_left"), spark.table("bucketed_right")
        plan = left.hint("merge").join(right.withColumnRenamed("v", "w"), "id")._jdf.queryExecution() \
            .executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_one_to_one_join(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "TransactionID bigint, s string, x double")
    right = spark.createDataFrame([(2, "z", None), (9, "q", 4.0)], "TransactionID bigint, s string, id_01 double")
    out = joins.join_one_to_one(left, right, fixed.ID, flag="present")
    assert out.columns == ["TransactionID", "s", "x", "s_identity", "id_01", "present"]
    assert {tuple(r) for r in out.collect()} == {(1, "a", 1.0, None, None, False), (2, "b", 2.0, "z", None, True)}
    cover = joins.join_coverage(out, "present").first()
    assert (cover.matched, cover.coverage) == (1, 50.0)
    assert joins.assert_same_rows(left, out) == 2
    for a, b in ((left.union(left), right), (left, right.union(right))):
        with pytest.raises(Exception, match="duplicate TransactionID"):
            joins.join_one_to_one(a, b, fixed.ID).count()
    with pytest.raises(ValueError):
        quality.assert_unique(left.union(left), fixed.ID)
    quality.assert_unique(left, fixed.ID)


def test_guard_and_join_share_one_shuffle_per_side(spark):
    left = spark.range(1000).withColumn("a", F.lit(1))
    right = spark.range(1000).withColumn("b", F.lit(1))
    plan = joins.join_one_to_one(left, right.hint("merge"), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_filters_and_columns_reach_the_scan(spark):
    path = work_path(spark, "pruned")
    spark.range(100).select("id", F.col("id").alias("a"), F.lit("x").alias("wide")).write.parquet(path)
    out = tables.read_parquet(spark, path, ["id", "a"]).where("a > 5").select("id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,5)" in plan and "wide" not in plan


def test_read_pair(spark):
    a, b = work_path(spark, "pair-a"), work_path(spark, "pair-b")
    export_csv(spark.range(3), a)
    export_csv(spark.range(5), b)
    schema = T.StructType.fromDDL("id bigint")
    left, right = tables.read_pair(spark, a, b, schema, schema)
    assert (left.count(), right.count()) == (3, 5)


def test_spread_join_with_a_hot_key(spark):
    rows = [(7, i) for i in range(500)] + [(i + 100, i) for i in range(200)] + [(None, -1)]
    left = spark.createDataFrame(rows, "k bigint, n bigint")
    right = spark.createDataFrame([(7, "hot"), (101, "cold")], "k bigint, v string")
    got = sorted(map(tuple, joins.spread_join(left, right, "k", salts=8, hot_share=0.1).collect()), key=str)
    want = sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    assert got == want and len(got) == 701


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, 0.0), (1, -0.0), (2, float("nan")), (2, float("nan")), (3, None)], "k int, x double")
    profile = quality.key_profile(df, "k").first()
    assert (profile.total_rows, profile.distinct_keys, profile.duplicates) == (5, 3, 2)
    assert quality.drop_exact_duplicates(df).count() == 3
    assert quality.removed_duplicates(df).first().removed == 2
    assert {r.column: r.distinct_values for r in quality.distinct_per_column(df).collect()} == {"k": 3, "x": 1}
    amount = quality.amount_profile(df, "x").first()
    assert (amount.amounts, amount.zero_or_negative) == (2, 2)
    assert [r.column for r in quality.high_cardinality(df, limit=2).collect()] == ["k"]
    check = quality.range_check(df, "x").first()
    assert (check.total_rows, check.out_of_range) == (5, 3)  # missing probabilities are out of range
    parents = spark.createDataFrame([(1,), (3,)], "id int")
    assert [tuple(r) for r in quality.orphan_keys(df, "k", parents, "id").collect()] == [(2, 2)]
    with pytest.raises(ValueError):
        quality.assert_no_orphans(df, "k", parents, "id")
    with pytest.raises(ValueError):
        quality.assert_frame(df.where("k > 9"))
    with pytest.raises(ValueError):
        quality.assert_frame(spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("A")))
    with pytest.raises(ValueError):
        quality.assert_frame(spark.range(1).select(F.col("id").alias("is_fraud")), "isFraud")
    quality.assert_frame(df, "isFraud")
    with pytest.raises(ValueError):
        quality.assert_result_columns(df, ["k", "fraud_probability"])


def test_empty_tables_report_zeros(spark):
    none = spark.createDataFrame([], "k int, x double")
    assert quality.key_profile(none, "k").first().total_rows == 0
    assert quality.amount_profile(none, "x").first().amounts == 0
    assert quality.key_coverage(none, none, "k").first().coverage == 0.0
    assert {r.missing_percentage for r in missingness.missing_profile(none).collect()} == {0.0}


def test_golden_check(spark):
    want = spark.createDataFrame([(3400379, 0.9854405522), (2, 0.5), (3, 0.1)], "id bigint, p double")
    got = spark.createDataFrame([(3400379, 0.985444), (2, 0.6)], "id bigint, p double")
    row = quality.golden_check(got, want, "id", "p", 1e-5).first()
    assert (row.expected_rows, row.found, row.mismatches) == (3, 2, 2)


def test_missingness_matches_pandas(spark):
    rows = [(1.0, None, "a", 1), (None, None, "b", 0), (3.0, 2.0, None, 1), (4.0, None, "d", None)]
    df = spark.createDataFrame(rows, "a double, b double, s string, y int")
    pdf = df.toPandas()
    got = {r.column: (r.missing_count, r.missing_percentage) for r in missingness.missing_profile(df).collect()}
    assert got == {c: (pdf[c].isna().sum(), pdf[c].isna().mean() * 100) for c in pdf.columns}
    rates = {r.missing_count: tuple(r)[1:] for r in missingness.rate_by_missing_count(
        df, ["a", "b", "s"], "y", min_rows=1).collect()}
    assert rates == {1: (2, 2, 1.0), 2: (1, 0, 0.0)}  # one count-1 row has no label
    sides = {r.column: (r.rate_missing, r.rate_present) for r in missingness.rate_missing_vs_present(
        df, ["a", "y"], "y").collect()}
    assert sides == {"a": (0.0, 1.0), "y": (0.0, pytest.approx(2 / 3))}
    flags = missingness.add_indicators(df, ["a", "s"]).select("a_missing", "s_missing").collect()
    assert sorted(map(tuple, flags)) == [(0, 0), (0, 0), (0, 1), (1, 0)]


def test_profiles_of_more_columns_than_one_block(spark):
    wide = spark.range(10).select(*[
        F.when(F.col("id") % (i + 2) > 0, F.col("id").cast("double")).alias(f"V{i}") for i in range(230)])
    got = {r.column: r.missing_count for r in missingness.missing_profile(wide).collect()}
    assert got == {f"V{i}": sum(1 for k in range(10) if k % (i + 2) == 0) for i in range(230)}
    assert wide.select(numeric.missing_count(wide.columns).alias("n")).agg(F.sum("n")).first()[0] == sum(got.values())


def test_describe_matches_pandas(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 10]] + [(float("nan"),), (None,)], "x double")
    got = missingness.describe(df, ["x"]).first()
    want = df.toPandas()["x"].describe()
    assert [got["count"], got["mean"], got["std"], got["min"], got.p25, got.p50, got.p75, got["max"]] == \
        pytest.approx(list(want))


def test_schema_steps(spark):
    names = ["TransactionID", "isFraud", "V2", "V1", "C1", "card1", "cardx", "id_01", "id_x", "ProductCD", "M1", "D1",
             "addr1", "DeviceInfo", "Vx", "P_emaildomain", "note"]
    assert schemas.select_features(names) == [
        "ProductCD", "card1", "addr1", "P_emaildomain", "C1", "D1", "M1", "V2", "V1", "id_01", "DeviceInfo"]
    df = spark.createDataFrame([], T.StructType.fromDDL(", ".join(f"{n} double" for n in names)))
    groups = {r.group: r.n for r in schemas.feature_group_counts(df).collect()}
    assert groups["v"] == 2 and groups["excluded"] == 5
    assert schemas.leakage_names(["Label", "isFraud", "x", "is_fraud"]) == ["Label", "is_fraud"]
    assert schemas.identifier_columns(["TransactionID", "id_01", "amount"]) == ["TransactionID", "id_01"]
    assert schemas.all_features(["TransactionID", "isFraud", "a"]) == ["a"]
    with pytest.raises(ValueError):
        schemas.assert_same_columns(["a", "c"], ["a", "b"])
    schemas.assert_same_columns(["b", "a"], ["a", "b"])
    schemas.assert_feature_contract(["a", "b", "a_missing", "b_missing"], 2)
    for bad in (["a", "a_missing", "b"], ["a", "b", "a_missing", "z_missing"]):
        with pytest.raises(ValueError):
            schemas.assert_feature_contract(bad, 2)
    with pytest.raises(TypeError):
        schemas.assert_numeric(spark.createDataFrame([], "a double, s string"), ["a", "s"])


def test_conform_uses_extras(spark):
    df = spark.createDataFrame([(1, {"V1": "2.5", "V2": "x"})], "TransactionID bigint, extras map<string,string>")
    out = schemas.conform(df, T.StructType.fromDDL("V2 double, V1 double, V3 double"), ["TransactionID"], "extras")
    assert tuple(out.first()) == (1, None, 2.5, None)


def test_scalars(spark):
    row = spark.range(1).select(
        numeric.exact_decimal(F.lit(0.043047092854976654), 12, 10).alias("p"),
        numeric.exact_decimal(F.lit(1265.5), 18, 6).alias("amount"),
        numeric.whole(F.lit(-3.9)).alias("whole"), numeric.half_even(F.lit(0.00125), 4).alias("half"),
        numeric.ratio(F.lit(1), F.lit(0)).alias("none"), text.store_key(F.lit(5)).alias("key"),
        text.id_matches(F.lit(3400379), "0379$").alias("found")).first()
    assert str(row.p) == "0.0430470929" and str(row.amount) == "1265.500000"
    assert (row.whole, row.half, row.none, row.key, row.found) == (-3, 0.0012, 0.0, "fraud:risk:5", True)


def test_clock_ignores_the_session_time_zone(spark):
    from pyspark.sql import types as T

    from cardwarden.functions.clock import epoch_micros, whole_units
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        times = ["1969-12-31 23:59:59.999999", "2024-03-10 02:30:00.5", "2024-07-01 12:00:00.000001"]
        df = spark.createDataFrame([(t,) for t in times], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        micros = epoch_micros(F.col("t"), T.TimestampNTZType())
        got = [tuple(r) for r in df.select(micros, whole_units(micros, 1000)).collect()]
        assert got == [(-1, -1), (1710037800500000, 1710037800500), (1719835200000001, 1719835200000)]
        with pytest.raises(TypeError):
            epoch_micros(F.col("t"), T.LongType())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bucketed_guard_join_and_split_move_nothing(spark):
    from cardwarden.plans import registry
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for sides of any size
    try:
        df = registry.QUERIES["bucketed_join_and_split"](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
