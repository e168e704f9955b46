import pytest
from pyspark.sql import functions as F

from cardwarden.operators import quality
from cardwarden.operators.running import RunningProfile
from cardwarden.session import work_path

SCHEMA = "id bigint, at bigint, amount double, bad int"


def rows(lo, hi):
    return [(i % 40 if i % 7 else None, 1000 - i, float("nan") if i % 5 == 0 else i - 3.0, i % 2) for i in range(lo, hi)]


@pytest.mark.parametrize("cuts", [[0, 100], [0, 30, 31, 100], [0, 10, 20, 40, 70, 100]])
def test_equals_a_full_scan_after_any_split(spark, cuts):
    at = work_path(spark, "t-running")
    profile = RunningProfile(spark, f"{at}/profile", "id", "at", "amount", "bad", rows_per_bucket=10, fan=2)
    read = lambda files: spark.read.schema(SCHEMA).parquet(*files)
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        spark.createDataFrame(rows(lo, hi), SCHEMA).repartition(2).write.mode("append").parquet(f"{at}/in")
        files = spark.read.schema(SCHEMA).parquet(f"{at}/in").inputFiles()
        opened = []
        assert profile.update(files, lambda some: opened.extend(some) or read(some)) == len(opened) > 0
        assert profile.update(files, read) == 0  # nothing new
        assert len(opened) == len(files) - len([f for f in files if f not in opened])
    every = spark.read.schema(SCHEMA).parquet(f"{at}/in")
    got = profile.report().first()
    keys = quality.key_profile(every.where("id is not null"), "id").first()
    amounts = quality.amount_profile(every, "amount").first()
    span = quality.value_range(every, "id", "at").first()
    assert (got.total_rows, got.missing_keys) == (every.count(), every.where("id is null").count())
    assert (got.distinct_keys, got.duplicates) == (keys.distinct_keys, keys.duplicates)
    assert (got.min_key, got.max_key, got.min_time, got.max_time) == (span.min_id, span.max_id, span.min_at, span.max_at)
    assert (got.minimum, got.maximum, got.amounts, got.zero_or_negative) == (
        amounts.minimum, amounts.maximum, amounts.amounts, amounts.zero_or_negative)
    assert got.mean == pytest.approx(amounts["mean"]) and (got.positives, got.negatives) == (50, 50)


def test_empty_files_and_an_empty_profile(spark):
    at = work_path(spark, "t-running-empty")
    profile = RunningProfile(spark, f"{at}/profile", "id", "at", "amount", "bad")
    assert profile.report().first().total_rows == 0 and profile.files() == []
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(f"{at}/in")
    spark.createDataFrame(rows(0, 5), SCHEMA).coalesce(1).write.mode("append").parquet(f"{at}/in")
    files = spark.read.schema(SCHEMA).parquet(f"{at}/in").inputFiles()
    read = lambda some: spark.read.schema(SCHEMA).parquet(*some)
    assert profile.update(files, read) == len(files) and profile.update(files, read) == 0
    assert profile.report().first().total_rows == 5


def test_a_crash_leaves_the_last_profile(spark, monkeypatch):
    at = work_path(spark, "t-running-crash")
    profile = RunningProfile(spark, f"{at}/profile", "id", "at", "amount", "bad")
    spark.createDataFrame(rows(0, 20), SCHEMA).coalesce(1).write.parquet(f"{at}/in")
    files = spark.read.schema(SCHEMA).parquet(f"{at}/in").inputFiles()
    read = lambda some: spark.read.schema(SCHEMA).parquet(*some)

    def lost(version):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(profile, "_commit", lost)
        with pytest.raises(OSError):
            profile.update(files, read)
    assert profile.report().first().total_rows == 0
    assert profile.update(files, read) == 1 and profile.report().first().total_rows == 20
