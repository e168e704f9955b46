import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.operators import lifetimes
from cardwarden.session import work_path
from cardwarden.streaming import jobs, lookups

SCHEMA = "rid bigint, id bigint, at bigint, op string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.timestamp_micros(F.col("at") * 1000))


def stream(spark, at, late_by=None):
    rows = spark.readStream.schema(f"{SCHEMA}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    out = lookups.answered(rows, "id", "ts", "rid", 10, F.col("op"), late_by)
    jobs.finish(jobs.to_files(out, f"{at}/out", f"{at}/cp", available_only=True))
    return {r.rid: r for r in spark.read.parquet(f"{at}/out").collect()}


def test_equals_the_batch_answer_over_batches_and_restarts(spark):
    rng = np.random.default_rng(7)
    n = 400
    when = np.sort(rng.integers(0, 200_000, n))
    rows = [(i, int(rng.integers(12)) if rng.random() < 0.95 else None, int(t), "score") for i, t in enumerate(when)]
    at = work_path(spark, "t-lookups")
    for run in range(2):  # three micro-batches, a stop, three more
        for b in range(3):
            lo = (run * 3 + b) * n // 6
            frame(spark, rows[lo:(run * 3 + b + 1) * n // 6]).coalesce(1).write.mode("append").parquet(f"{at}/in")
        got = stream(spark, at)
    want = {r.rid: r.source for r in lifetimes.lookup_sources(frame(spark, rows), "id", "ts", "rid", 10).collect() if r.id is not None}
    assert {k: r.source for k, r in got.items()} == want
    assert set(want.values()) == {"model", "cache", "database"}


def test_get_put_delete_and_what_remains(spark):
    rows = [(1, 5, 0, "get"), (2, 5, 1000, "put"), (3, 5, 3000, "get"), (4, 5, 10_999, "get"), (5, 5, 11_000, "get"),
            (6, 5, 12_000, "score"), (7, 5, 13_000, "delete"), (8, 5, 14_000, "get"), (9, 5, 15_000, "score"),
            (10, 6, 15_000, "delete"), (11, 6, 16_000, "score"), (12, 5, 16_000, "score"), (13, 5, 17_000, "delete"), (14, 5, 17_000, "delete")]
    at = work_path(spark, "t-ops")
    frame(spark, rows).coalesce(1).write.parquet(f"{at}/in")
    got = stream(spark, at)
    assert {k: r.found for k, r in got.items()} == {
        1: False, 2: False, 3: True, 4: True, 5: False, 6: False, 7: True, 8: False, 9: False, 10: False, 11: False, 12: True,
        13: True, 14: False}
    assert got[3].remaining_seconds == 8.0 and got[4].remaining_seconds == 0.001 and got[5].remaining_seconds is None
    assert [got[k].source for k in (6, 9, 11, 12)] == ["database", "database", "model", "cache"]


def test_timers_drop_entries_the_watermark_has_passed(spark):
    at = work_path(spark, "t-timers")
    for rows in ([(1, 5, 1000, "score")], [(2, 6, 100_000, "score")], [(3, 5, 101_000, "score"), (4, 5, 102_000, "get")]):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{at}/in")
    got = stream(spark, at, "1 second")
    assert (got[3].source, got[4].found) == ("database", True)


def test_unknown_requests_and_lifetimes_raise(spark):
    with pytest.raises(ValueError, match="unknown"):
        lookups.answer("peek", 0, 0, False, 1)
    with pytest.raises(ValueError, match="lifetime"):
        lookups.answered(frame(spark, []), "id", "ts", "rid", 0)


def test_many_small_groups_share_a_batch_and_one_is_longer(spark):
    """Blocks of many ids are cut out of sorted batches; one id's block goes over several."""
    rng = np.random.default_rng(11)
    ids = [f"u{int(i)}" for i in np.where(rng.random(900) < 0.3, 0, rng.integers(1, 120, 900))]
    at = np.sort(rng.integers(0, 3_000_000, 900)).tolist()
    requests = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(zip(ids, at))], "rid bigint, id string, at bigint").select(
        "rid", "id", F.timestamp_micros(F.col("at") * 1000).alias("ts"))
    expires, want = {}, {}
    for i, (k, t) in enumerate(zip(ids, at)):
        want[i] = "cache" if t < expires.get(k, -1) else "database" if k in expires else "model"
        if want[i] != "cache":
            expires[k] = t + 20_000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    try:
        found = lifetimes.lookup_sources(requests, "id", "ts", "rid", 20)
        plan = found._jdf.queryExecution().toString()
        assert "MapInPandas" in plan and "FlatMapGroupsInPandas" not in plan
        assert {r.rid: r.source for r in found.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
