import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import joins, lifetimes, metrics, predictions

T0 = datetime.datetime(2024, 1, 1)


def at(seconds):
    return T0 + datetime.timedelta(seconds=seconds)


def test_transaction_and_prediction_types(spark):
    df = spark.createDataFrame(
        [(999999998, 123456.0, 1265.50, "W", 12345.0, 111.0, 150.0, "visa", 226.0, "credit", 100.0, 87.9, 10.5, None,
          "gmail.com", None, 0.043047092854976654, False, fixed.LEGITIMATE, 0.60, 854.4269)],
        "TransactionID bigint, TransactionDT double, TransactionAmt double, ProductCD string, card1 double, card2 double, "
        "card3 double, card4 string, card5 double, card6 string, addr1 double, addr2 double, dist1 double, dist2 double, "
        "P_emaildomain string, R_emaildomain string, fraud_probability double, fraud_prediction boolean, decision string, "
        "threshold double, prediction_latency_ms double")
    t = predictions.transaction_rows(df).first()
    assert t.transaction_amt == Decimal("1265.5") and t.addr2 == 87 and t.dist2 is None and t.actual_fraud is None
    p = predictions.prediction_rows(df, "m", "6").first()
    assert (p.fraud_probability, p.threshold, p.prediction_latency_ms) == (
        Decimal("0.0430470929"), Decimal("0.6000"), Decimal("854.4269"))


def log(spark, rows):
    return spark.createDataFrame(rows, "transaction_id bigint, created_at timestamp, decision string")


def test_score_once_precedence(spark):
    stored = log(spark, [(1, at(10), "old"), (1, at(20), "new")])
    requests = log(spark, [(1, at(99), "?"), (2, at(99), "later"), (2, at(98), "first"), (2, at(99), "later")])
    calls = []

    def score(new):
        calls.append(sorted(r.transaction_id for r in new.collect()))
        return new
    by = [F.col("created_at")]
    got = {tuple(r) for r in predictions.score_once(requests, stored, "transaction_id", by, by, score).collect()}
    assert got == {(1, at(20), "new", "stored"), (2, at(98), "first", "model")} and calls == [[2]]


def test_new_keys_beyond_the_broadcast_bound(spark, monkeypatch):
    batch = spark.range(50).select((F.col("id") % 10).alias("k"), "id")
    table = spark.createDataFrame([(i,) for i in (0, 0, 5)], "k bigint")
    want = {(k, k) for k in range(10) if k not in (0, 5)}
    for bound in (1_000_000, 3):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", bound)
        assert {tuple(r) for r in predictions.new_keys(batch, table, "k", [F.col("id")]).collect()} == want


def test_delete_cascade(spark):
    t = log(spark, [(1, at(0), "a"), (2, at(0), "b")])
    p = log(spark, [(1, at(0), "x"), (1, at(1), "y"), (2, at(2), "z")])
    kept, children = predictions.delete_cascade(t, p, t.where("transaction_id = 1"))
    assert [r.transaction_id for r in kept.collect()] == [2] and [r.decision for r in children.collect()] == ["z"]


def test_lifetimes_of_entries(spark):
    entries = predictions.with_expiry(log(spark, [(1, at(0), "a"), (2, at(30), "b")]), ttl_seconds=60)
    live = predictions.live_entries(entries, F.lit(at(60))).collect()
    assert [(r.transaction_id, r.remaining_seconds) for r in live] == [(2, 30.0)]  # at its expiry an entry is gone
    assert predictions.drop_entries(entries, entries.where("transaction_id = 2"), "transaction_id").count() == 1
    with pytest.raises(ValueError):
        predictions.with_expiry(entries, ttl_seconds=0)


def replay(rows, ttl_ms):
    """Brute force: one request after the other."""
    expiry, out = {}, {}
    for rid, key, ms in sorted(rows, key=lambda r: (r[2], r[0])):
        if key not in expiry:
            out[rid], expiry[key] = "model", ms + ttl_ms
        elif ms < expiry[key]:
            out[rid] = "cache"
        else:
            out[rid], expiry[key] = "database", ms + ttl_ms
    return out


@pytest.mark.parametrize("group_rows,max_fan,ttl", [(5_000_000, 4096, 3.0), (4, 2, 3.0), (40, 3, 0.25), (1, 2, 50.0)])
def test_lookup_replay_equals_brute_force(spark, monkeypatch, group_rows, max_fan, ttl):
    monkeypatch.setattr(lifetimes, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(lifetimes, "MAX_FAN", max_fan)
    rng = random.Random(int(ttl * 100) + max_fan)
    rows = []
    for rid in range(600):
        key = 0 if rng.random() < 0.4 else rng.randint(1, 5)
        rows.append((rid, key, int(rng.random() ** 2 * 40_000)))
    df = spark.createDataFrame(
        [(rid, key, at(0) + datetime.timedelta(milliseconds=ms)) for rid, key, ms in rows],
        "rid bigint, k bigint, ts timestamp")
    got = {r.rid: r.source for r in lifetimes.lookup_sources(df, "k", "ts", "rid", ttl).collect()}
    assert got == replay(rows, int(ttl * 1000))


def test_lookup_replay_of_nothing(spark):
    df = spark.createDataFrame([], "rid bigint, k bigint, ts timestamp")
    assert lifetimes.lookup_sources(df, "k", "ts", "rid").count() == 0
    with pytest.raises(ValueError):
        lifetimes.lookup_sources(df, "k", "ts", "rid", 0)


def test_recent_joined_keeps_unmatched_and_repeated_ids(spark):
    p = log(spark, [(1, at(1), "a"), (1, at(2), "b"), (7, at(3), "c"), (2, at(0), "d")])
    t = spark.createDataFrame([(1, "W"), (2, "H")], "transaction_id bigint, product_cd string")
    got = {(r.transaction_id, r.decision, r.product_cd) for r in joins.recent_joined(
        p, t, "transaction_id", [F.desc("created_at")], 3).collect()}
    assert got == {(1, "a", "W"), (1, "b", "W"), (7, "c", None)}


def test_children_newest_first(spark):
    children = log(spark, [(1, at(1), "a"), (1, at(3), "b"), (2, at(9), "x")])
    parents = spark.createDataFrame([(1,)], "transaction_id bigint")
    out = joins.children_newest_first(parents, children, "transaction_id", [F.desc("created_at")])
    assert [r.decision for r in out.collect()] == ["b", "a"]


def test_recent_activity_columns_and_filter(spark):
    p = spark.createDataFrame(
        [(1, 0.9, True, fixed.REVIEW, 1.0, at(1)), (2, 0.1, False, fixed.LEGITIMATE, 2.0, at(2))],
        "transaction_id bigint, fraud_probability double, fraud_prediction boolean, decision string, "
        "prediction_latency_ms double, created_at timestamp")
    t = spark.createDataFrame([(1, 5.0, "W", "visa")], "transaction_id bigint, transaction_amt double, product_cd string, card4 string")
    report = joins.recent_activity(p, t)
    assert report.columns == list(joins.RECENT_NAMES.values())
    assert [r.TransactionID for r in joins.with_decision(report, "fraud").collect()] == [1]
    assert [r.TransactionID for r in joins.with_decision(report, "legitimate").collect()] == [2]
    assert joins.with_decision(report).count() == 2


def test_histograms_and_quantiles(spark):
    df = spark.createDataFrame([(v,) for v in [0.001, 0.0015, 0.003, 0.3, 0.9]], "v double")
    rows = {r.le: r.cumulative for r in metrics.histogram(df, "v", fixed.INFERENCE_SECONDS_BOUNDS).collect()}
    assert rows[0.001] == 1 and rows[0.002] == 2 and rows[0.25] == 3 and rows[float("inf")] == 5
    q = {r.quantile: r.value for r in metrics.histogram_quantiles(
        df, "v", fixed.INFERENCE_SECONDS_BOUNDS, [0.1, 0.5, 0.99]).collect()}
    assert q[0.1] == pytest.approx(0.0005)          # half of the first bucket, which starts at 0
    assert q[0.5] == pytest.approx(0.0035)          # 2.5 of 5 rows: half of (0.002, 0.005]
    assert q[0.99] == 0.5                           # beyond the last bound
    empty = metrics.histogram_quantiles(df.where("v < 0"), "v", [1.0], [0.5]).first()
    assert empty.value is None


def test_counters_of_an_empty_log(spark):
    none = spark.createDataFrame([], "decision string, prediction_latency_ms double")
    assert metrics.flagged_total(none).first().flagged == 0
    assert tuple(metrics.kpis(none).first()) == (0, 0, 0.0, 0.0)
    assert metrics.run_summary(none).first().flagged_percentage == 0.0


@pytest.mark.parametrize("shift", [0, 10_000, -10_000])
def test_lifetimes_do_not_depend_on_where_time_is_zero(spark, shift):
    epoch = datetime.datetime(1970, 1, 1)
    rows = [(1, "a", epoch + datetime.timedelta(seconds=shift - 290)), (2, "a", epoch + datetime.timedelta(seconds=shift + 20)),
            (3, "b", epoch + datetime.timedelta(seconds=shift)), (4, None, epoch), (5, None, epoch), (6, "a", None)]
    got = lifetimes.lookup_sources(spark.createDataFrame(rows, "rid bigint, id string, t timestamp_ntz"), "id", "t", "rid", 300)
    assert {r.rid: r.source for r in got.collect()} == {1: "model", 2: "database", 3: "model", 4: None, 5: None, 6: None}


def test_spread_join_leaves_no_large_partition(spark):
    """A key with a third of the rows and as many rows without a key end up all over the place."""
    rows = spark.range(30_000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    right = spark.range(30_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.spread_join(rows, right, "k")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 2.5 * 30_000 / 8
        assert joined.where("k is not null and (v is null or v <> 2 * k)").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
