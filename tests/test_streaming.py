import json

import pytest
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators.validation import accepted, rejected, with_reasons
from cardwarden.plans.streams import amount_score
from cardwarden.schemas import BUS_RECORD, TRANSACTION
from cardwarden.session import work_path
from cardwarden.sources.bus import captured_stream
from cardwarden.streaming import jobs
from cardwarden.streaming.parse import parse_records, parse_with_extras
from cardwarden.streaming.score_once import score_batch
from cardwarden.streaming.store import PredictionStore


def records(spark, values, start=0):
    rows = [(str(i).encode(), (v if isinstance(v, str) else json.dumps(v)).encode(), "t", 0, start + i, None)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, BUS_RECORD)


def message(key, amount=100.0, **more):
    return {"TransactionID": key, "TransactionDT": 86400, "TransactionAmt": amount, "ProductCD": "W", **more}


def test_parse(spark):
    rows = parse_records(records(spark, [
        message(3400379, 1265.5, card1=13926.0, dist2=None, isFraud=0),
        {"TransactionID": 9007199254740993, "TransactionAmt": "12.5", "addr1": "abc"},
        "not json", '{"TransactionAmt": NaN}'])).collect()
    assert rows[0].card1 == 13926 and rows[0].dist2 is None and rows[0].isFraud == 0 and rows[0].offset == 0
    assert rows[1].TransactionID == 9007199254740993 and rows[1].TransactionAmt == 12.5 and rows[1].addr1 is None
    assert rows[2].TransactionID is None and rows[2].topic == "t" and rows[3].TransactionAmt is None
    assert list(rows[0].asDict())[:17] == TRANSACTION.names


def test_validation(spark):
    checked = with_reasons(parse_with_extras(records(spark, [
        message(1, V7=3), {"TransactionID": 999999997, "TransactionAmt": 100.0},
        {"TransactionDT": 123456.0, "TransactionAmt": 100.0}, message(4, card2="x"), "oops"])), TRANSACTION)
    got = {r.offset: r.reasons for r in checked.collect()}
    assert got[0] == [] and got[1] == ["missing:TransactionDT"] and got[2] == ["missing:TransactionID"]
    assert got[3] == ["type:card2"] and len(got[4]) == 3
    assert accepted(checked).first().extras == {"V7": "3"} and rejected(checked).count() == 4


def score_all(spark, values, batches=1, query=None, at=None):
    """Run the scoring stream over captured files, one file per micro-batch."""
    at = at or work_path(spark, "t-stream")
    per = -(-len(values) // batches)
    for b in range(batches):
        records(spark, values[b * per:(b + 1) * per], b * per).coalesce(1).write.mode("append").parquet(f"{at}/in")
    store = PredictionStore(spark, f"{at}/store")
    handler = score_batch(store, amount_score, "m", "1", [F.col("offset")], f"{at}/rejects", query)
    jobs.finish(jobs.each_batch(captured_stream(spark, f"{at}/in", 1), handler, f"{at}/cp", True))
    return store, handler, at


def test_score_once_across_batches(spark):
    values = [message(1, 10.0), message(2, 400.0), message(1, 499.0), {"TransactionID": 5},
              message(2, 1.0), message(3, 75.0), message(1, 1.0), message(3, 2.0)]
    store, _, at = score_all(spark, values, batches=2)
    got = {r.transaction_id: (float(r.fraud_probability), r.decision) for r in store.predictions().collect()}
    assert got == {1: (0.02, fixed.LEGITIMATE), 2: (0.8, fixed.REVIEW), 3: (0.15, fixed.REVIEW)}
    assert sorted(r.transaction_id for r in store.transactions().collect()) == [1, 2, 3]
    assert store.predictions().where("prediction_latency_ms >= 0").count() == 3
    assert [r.reasons for r in spark.read.parquet(f"{at}/rejects").collect()] == [
        ["missing:TransactionDT", "missing:TransactionAmt"]]


def test_replayed_and_half_written_batches(spark):
    store, handler, _ = score_all(spark, [message(1, 10.0)], query="q")
    handler(records(spark, [message(1, 999.0), message(2, 20.0)]), 0)  # committed already: nothing happens
    assert store.predictions().count() == 1
    # a crash after the first table of batch 1: its rows stay invisible and are rewritten on replay
    half = store.transactions().limit(1).withColumn("transaction_id", F.lit(77).cast("bigint"))
    store._write("transactions", half, 2)
    assert store.transactions().count() == 1
    handler(records(spark, [message(2, 20.0), message(1, 5.0)]), 1)
    assert sorted(r.transaction_id for r in store.transactions().collect()) == [1, 2]
    assert sorted(r.transaction_id for r in store.predictions().collect()) == [1, 2]


def test_new_checkpoints_and_second_queries_lose_nothing(spark):
    """Batch numbers repeat with every checkpoint and between queries; ids are still stored once each."""
    store, _, at = score_all(spark, [message(i) for i in range(5)])
    for n, checkpoint in ((5, "cp2"), (10, "cp3")):
        records(spark, [message(i) for i in range(n - 1, n + 5)] + [{"TransactionID": 900 + n}]).coalesce(1).write.parquet(f"{at}/in{n}")
        handler = score_batch(store, amount_score, "m", "1", [F.col("offset")], f"{at}/rejects")
        jobs.finish(jobs.each_batch(captured_stream(spark, f"{at}/in{n}", 1), handler, f"{at}/{checkpoint}", True))
    assert sorted(r.transaction_id for r in store.predictions().collect()) == list(range(15))
    assert sorted(r.transaction_id for r in store.transactions().collect()) == list(range(15))
    assert len(store.version().writers) == 3
    assert spark.read.parquet(f"{at}/rejects").count() == 2


def test_a_handler_outside_a_stream_needs_a_name(spark):
    at = work_path(spark, "t-name")
    store = PredictionStore(spark, f"{at}/store")
    with pytest.raises(ValueError, match="name"):
        score_batch(store, amount_score, "m", "1", [F.col("offset")], f"{at}/rejects")(records(spark, [message(1)]), 0)


def test_streams_read_a_folder_of_part_files(spark, tmp_path):
    from cardwarden.plans import registry
    whole = "/root/testdata/sf0.001"
    spark.read.parquet(f"{whole}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_parse", "stream_rates", "stream_score_once", "stream_rejects", "stream_first_within_horizon"):
        got, want = (registry.QUERIES[name](spark, d) for d in (str(tmp_path), whole))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_bounded_tables_lose_no_late_rows(spark, tmp_path):
    """110 part files of day 200, then 110 of day 0: whole batches of rows that a watermark takes for late."""
    from cardwarden.plans import registry
    for n, day in enumerate((200, 0)):
        spark.range(n * 1100, (n + 1) * 1100).selectExpr(
            "id AS event_id", f"CAST(TIMESTAMP'2024-01-01 00:00:00' + INTERVAL '{day}' DAY AS TIMESTAMP_NTZ) AS ts", "id AS user_id",
            "'click' AS event_type", "1.0D AS value", "'{}' AS props").repartition(110).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    assert sum(r.events for r in registry.QUERIES["stream_rates"](spark, str(tmp_path)).collect()) == 2200
    assert registry.QUERIES["stream_first_within_horizon"](spark, str(tmp_path)).where("n = 1").count() == 2200


def test_whole_numbers_are_truncated(spark):
    rows = parse_records(records(spark, [message(1, card1="13926.99999"), message(2, card1="-0.99999"), message(3, card1="9223372036854775807")])).collect()
    assert [r.card1 for r in rows] == [13926, 0, 2 ** 63 - 1]


def test_file_sink_restart_takes_only_new_records(spark):
    at = work_path(spark, "t-files")
    for n in (3, 5):
        records(spark, [message(i) for i in range(n)]).write.mode("append").parquet(f"{at}/in")
        rows = parse_records(captured_stream(spark, f"{at}/in"))
        jobs.finish(jobs.to_files(rows, f"{at}/out", f"{at}/cp", True))
    assert spark.read.parquet(f"{at}/out").count() == 8


def test_console_sink_runs(spark):
    at = work_path(spark, "t-console")
    records(spark, [message(1)]).write.parquet(f"{at}/in")
    query = jobs.to_console(parse_records(captured_stream(spark, f"{at}/in")), f"{at}/cp")
    query.processAllAvailable()
    query.stop()


def test_failing_query_raises(spark):
    at = work_path(spark, "t-fail")
    records(spark, [message(1)]).write.parquet(f"{at}/in")

    def boom(df, n):
        raise RuntimeError("no")
    with pytest.raises(Exception, match="no"):
        jobs.finish(jobs.each_batch(captured_stream(spark, f"{at}/in"), boom, f"{at}/cp", True))


def test_windows_of_a_new_checkpoint_add_up(spark):
    """Three files in three batches, then two more under a new checkpoint: five events, not three."""
    at = work_path(spark, "t-windows")
    for run, files in (("cp1", 3), ("cp2", 2)):
        for i in range(files):
            spark.sql(f"select timestamp'2024-01-01 00:00:0{i}' as ts, 'a' as kind").write.mode("append").parquet(f"{at}/{run}-in")
        rows = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).parquet(f"{at}/{run}-in")
        jobs.finish(jobs.to_latest_windows(jobs.windowed_counts(rows, "ts", ["kind"], late_by=None), f"{at}/out", f"{at}/{run}", True))
    assert [r.events for r in jobs.latest_windows(spark.read.parquet(f"{at}/out"), ["minute", "kind"]).collect()] == [5]
