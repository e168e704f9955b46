import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwarden.operators import ordering, split, topk


def frame(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.lognormal(3, 3, 700), -rng.exponential(1e-6, 200), np.full(450, 5.25)])
    rng.shuffle(values)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = ordering.exact_quantiles(frame(spark, values), ["x"], probs)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_quantiles_skip_missing_and_allow_constant_or_empty_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, 7.0), (2.0, None, 7.0), (float("nan"), None, 7.0), (10.0, None, None)],
        "a double, b double, c double")
    assert ordering.exact_quantiles(df, ["a", "b", "c"], [0.5]) == {"a": [2.0], "b": [None], "c": [7.0]}


def test_quantiles_with_two_cells_still_exact(spark):
    values = list(range(50)) * 2
    long = ordering.long_values(frame(spark, values), ["x"])
    hits = ordering.order_statistics(long, {"x": [0, 33, 99]}, cells=2)
    assert {k[1]: (v.value, v.below) for k, v in hits.items()} == {0: (0.0, 0), 33: (16.0, 32), 99: (49.0, 98)}


def test_quantiles_refuse_infinite_values(spark):
    with pytest.raises(ValueError):
        ordering.exact_quantiles(frame(spark, [1.0, float("inf")]), ["x"], [0.5])


def test_dense_codes_are_sorted_ranks(spark):
    words = [f"w{i * 7919 % 5000}" for i in range(3000)] + ["", "é", "Z"]
    df = spark.createDataFrame([(w,) for w in set(words)], "v string")
    got = {r.v: r.code for r in ordering.dense_codes(df, "v", spread=16).collect()}
    want = {w: i for i, w in enumerate(sorted(set(words), key=lambda s: s.encode()))}
    assert got == want


def test_first_by_breaks_ties_and_keeps_maps(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 9, "z"), (2, 3, "q")], "k int, t int, v string")
    first = {tuple(r) for r in ordering.first_by(df, "k", [F.col("t")]).collect()}
    last = {tuple(r) for r in ordering.first_by(df, "k", [F.col("t")], latest=True).collect()}
    assert first == {(1, 5, "a"), (2, 3, "q")} and last == {(1, 9, "z"), (2, 3, "q")}
    mapped = df.withColumn("m", F.create_map(F.lit("v"), "v")).drop("v")
    assert ordering.first_by(mapped, "k", [F.col("t")], latest=True).where("k = 1").first().m == {"v": "z"}


@pytest.mark.parametrize("n", [1, 2, 7, 1001])
def test_temporal_split_with_a_time_shared_by_a_third(spark, n):
    rng = np.random.default_rng(n)
    times = np.where(np.arange(n) % 3 == 0, 500, rng.integers(0, 1000, n))
    pdf = pd.DataFrame({"t": times, "id": rng.permutation(n) * 3})
    got = split.temporal_split(spark.createDataFrame(pdf), "t", "id").toPandas()
    order = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    a, b = int(n * 0.70), int(n * 0.85)
    order["want"] = np.where(order.index < a, "train", np.where(order.index < b, "valid", "test"))
    both = got.merge(order, on="id")
    assert len(both) == n and (both["split"] == both["want"]).all()


def test_temporal_split_puts_missing_times_last(spark):
    df = spark.createDataFrame([(None, i) for i in range(8)] + [(i, 100 + i) for i in range(12)], "t bigint, id bigint")
    got = {r.id: r.split for r in split.temporal_split(df, "t", "id").collect()}
    order = [100 + i for i in range(12)] + list(range(8))
    assert got == {k: "train" if i < 14 else "valid" if i < 17 else "test" for i, k in enumerate(order)}


def test_sample_is_exact_and_independent_of_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k for r in topk.sample_rows(df, "k", 77).collect()}
    b = {r.k for r in topk.sample_rows(df.repartition(13), "k", 77).collect()}
    c = {r.k for r in topk.sample_rows(df, "k", 77, seed=7).collect()}
    assert len(a) == 77 and a == b and a != c
    assert topk.sample_rows(df, "k", 5000).count() == 1000


def test_first_positive_needs_a_positive(spark):
    df = spark.createDataFrame([(3, 1), (2, 1), (1, 0)], "k int, y int")
    assert topk.first_positive(df, "y", "k").first().k == 2
    with pytest.raises(ValueError):
        topk.first_positive(df.where("y = 0"), "y", "k")


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    out = topk.top_per_group(df, ["g"], [F.desc("v")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {(r.g, r.v) for r in out.collect()} == {(0, 99), (0, 96), (1, 97), (1, 94), (2, 98), (2, 95)}


def test_temporal_split_tells_large_and_missing_ids_apart(spark):
    rows = [(1000, 2 ** 60 + i) for i in range(20)]
    parts = [r.split for r in split.temporal_split(spark.createDataFrame(rows, "t bigint, id bigint"), "t", "id").collect()]
    assert [parts.count(p) for p in split.PARTS] == [14, 3, 3]
    rows = [(1000, i) for i in range(18)] + [(1000, None)] * 2
    parts = [r.split for r in split.temporal_split(spark.createDataFrame(rows, "t bigint, id bigint"), "t", "id").collect()]
    assert [parts.count(p) for p in split.PARTS] == [14, 3, 3]


def test_whole_ranks_over_the_full_range(spark):
    values = sorted([-2 ** 63, -1, 0, 5, 5, 5, 2 ** 53 + 1, 2 ** 53 + 2, 2 ** 63 - 1])
    found = split.whole_at_ranks(spark.createDataFrame([(v,) for v in values], "v bigint"), "v", list(range(9)))
    assert {r: v for r, (v, _) in found.items()} == dict(enumerate(values))
    assert all(below == sum(x < v for x in values) for v, below in found.values())


def test_a_column_per_feature_narrows_as_rows_do(spark, monkeypatch):
    """Few columns are narrowed in one expression a row, with the values of the unpivoted table."""
    rng = np.random.default_rng(5)
    columns = {"a": rng.lognormal(size=4000), "b": np.round(rng.normal(size=4000)), "c d": np.full(4000, 7.0), "none": np.full(4000, np.nan)}
    columns["a"][rng.random(4000) < 0.2] = np.nan
    df = spark.createDataFrame(pd.DataFrame(columns)).repartition(3)
    wide = ordering.exact_quantiles(df, list(columns), [0.1, 0.5, 0.9])
    monkeypatch.setattr(ordering, "_narrow_wide", None)
    monkeypatch.setattr(ordering, "WIDE_INTERVALS", 0)
    assert wide == ordering.exact_quantiles(df, list(columns), [0.1, 0.5, 0.9])
    assert wide["a"] == pytest.approx(np.nanquantile(columns["a"], [0.1, 0.5, 0.9])) and wide["none"] == [None] * 3
