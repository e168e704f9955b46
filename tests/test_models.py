import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardwarden import fixed
from cardwarden.operators import boosting, evaluate, explain, features, models
from cardwarden.plans import risk
from cardwarden.session import work_path


@pytest.fixture(scope="module")
def card(spark):
    rng = np.random.default_rng(3)
    n = 900
    pdf = pd.DataFrame({
        "TransactionID": np.arange(n), "TransactionDT": rng.integers(86400, 99999, n),
        "TransactionAmt": rng.lognormal(4, 1, n), "C1": rng.integers(0, 9, n).astype(float),
        "ProductCD": rng.choice(list("WHC"), n)})
    pdf.loc[rng.random(n) < 0.3, "C1"] = None
    pdf["isFraud"] = ((pdf.C1.fillna(9) > 6) & (rng.random(n) < 0.8)).astype(int)
    pdf.loc[5, "ProductCD"] = None
    path = work_path(spark, "card-test")
    df = spark.createDataFrame(pdf.astype({"ProductCD": object}))
    df.withColumn("C1", F.nanvl("C1", F.lit(None))).write.parquet(path)
    return spark.read.parquet(path)


NUM, CAT = ["TransactionAmt", "C1"], ["ProductCD"]


def vectors(model, df, key="k"):
    return {r[key]: r.x for r in model.transform(df).select(key, vector_to_array("features").alias("x")).collect()}


def test_transforms_use_training_statistics_only(spark):
    train = spark.createDataFrame([(1, 1.0, None, "b", "x"), (2, 2.0, None, "a", None), (3, 10.0, None, None, None)],
                                  "k int, n double, gone double, c string, d string")
    new = spark.createDataFrame([(9, None, 5.0, "zzz", "x"), (8, float("nan"), None, None, "y")], train.schema)
    model = features.fit_features(train, ["n", "gone"], ["c", "d"], indicators=True)
    assert features.feature_names(model) == ["n", "n_missing", "c_missing", "d_missing", "c", "d"]
    # categories of c: a, b, missing; of d: missing, x
    assert vectors(model, train) == {1: [1, 0, 0, 0, 1, 1], 2: [2, 0, 0, 1, 0, 0], 3: [10, 0, 1, 1, 2, 0]}
    assert vectors(model, new)[9] == [2.0, 1, 0, 0, -1, 1]
    assert vectors(model, new)[8][0] == 2.0


def test_one_hot_unseen_is_all_zero_and_quotes_survive(spark):
    train = spark.createDataFrame([(1, "it's"), (2, "b\\c"), (3, None)], "k int, c string")
    model = features.fit_features(train, [], ["c"], encoding="onehot", categorical_fill="most_frequent")
    assert features.most_frequent(train, ["c"]) == {"c": "b\\c"}  # a tie: the smaller
    assert features.feature_names(model) == ["c=b\\c", "c=it's"]
    assert vectors(model, train) == {1: [0, 1], 2: [1, 0], 3: [1, 0]}
    assert vectors(model, spark.createDataFrame([(4, "new")], train.schema)) == {4: [0, 0]}


def test_category_limit(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="too many categories"):
        features.categories(df, ["c"], {"c": "missing"}, limit=20)
    codes = features.ordinal_codes(df, "c")
    out = features.encode_by_join(df.union(spark.createDataFrame([("?",)], "c string")), "c", codes, "code")
    got = {r.c: r.code for r in out.collect()}
    assert got == {**{s: i for i, s in enumerate(sorted(map(str, range(50))))}, "?": -1}


def wide_table(spark, n):
    rows = spark.range(n).select("id", F.concat(F.lit("c"), "id").alias("wide"), F.when(F.col("id") % 3 > 0, F.concat(
        F.lit("k"), (F.col("id") % 3).cast("string"))).alias("thin"), (F.col("id") % 2).cast("int").alias("isFraud"))
    path = work_path(spark, "wide-test")
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("encoding", ["ordinal", "onehot"])
def test_wide_categories_get_the_same_codes_from_a_stored_table(spark, encoding):
    df = wide_table(spark, 60).union(spark.createDataFrame([(60, None, None, 0)], "id bigint, wide string, thin string, isFraud int"))
    inside = features.fit_features(df, [], ["wide", "thin"], encoding=encoding)
    stored = features.fit_features(df, [], ["wide", "thin"], encoding=encoding, limit=20)
    assert [type(s).__name__ for s in stored.stages].count("CodeLookup") == 1
    new = df.union(spark.createDataFrame([(99, "unseen", "k1", 0)], df.schema))
    assert vectors(stored, new, "id") == vectors(inside, new, "id")
    assert features.feature_inputs(stored) == ["wide", "thin"] and len(features.feature_names(stored)) == len(features.feature_names(inside))


def test_a_model_with_a_million_categories_is_saved_with_its_table(spark):
    df = wide_table(spark, 1_000_000)
    inputs = models._inputs([], ["wide", "thin"])
    transforms = features.fit_features(df, [], ["wide", "thin"])
    lookup = next(s for s in transforms.stages if isinstance(s, features.CodeLookup))
    assert lookup.getOrDefault("size") == 1_000_000
    forest = boosting.Forest.empty(1, 1, 2)
    forest.cover[0, :], forest.feature[0, 0], forest.cut[0, 0], forest.value[0, 1:] = 1.0, 0, 500_000.0, (-1.0, 1.0)
    model, path = models.RiskModel(transforms, inputs, forest), work_path(spark, "wide-model")
    model.save(path)
    again = models.RiskModel.load(spark, path)
    scored = again.score(df, ["id"]).agg(F.count_if("fraud_prediction").alias("high"), F.count("*").alias("n")).first()
    assert (scored.high, scored.n) == (500_000, 1_000_000)
    assert next(s for s in again.pipeline.stages if isinstance(s, features.CodeLookup)).getOrDefault("path").startswith(path)


def test_linear_fit_scores_and_attributions(spark, card):
    model = models.fit_linear(card, NUM, CAT, iterations=50)
    scored = model.score(card, [fixed.ID, fixed.TARGET])
    assert scored.columns == [fixed.ID, fixed.TARGET, *models.SCORE_COLUMNS]
    assert scored.where("NOT fraud_probability BETWEEN 0 AND 1").count() == 0
    assert scored.where(f"fraud_prediction <> (fraud_probability >= {fixed.THRESHOLD})").count() == 0
    assert scored.where(f"fraud_prediction <> (decision = '{fixed.REVIEW}')").count() == 0
    values = explain.linear_attributions(model, card, card, fixed.ID)
    margin = F.col("base") + F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    worst = values.withColumn("p", 1 / (1 + F.exp(-margin))).join(scored, fixed.ID).agg(
        F.max(F.abs(F.col("p") - F.col("fraud_probability")))).first()[0]
    assert worst < 1e-9
    total = values.agg(*[F.avg(F.col("values")[i]) for i in range(len(model.names))]).first()
    assert max(map(abs, total)) < 1e-9


def test_model_round_trip_and_sparse_input(spark, card):
    model = models.fit_linear(card, NUM, CAT, iterations=20)
    path = work_path(spark, "model-test")
    model.save(path)
    again = models.RiskModel.load(spark, path)
    a = {r[0]: r[1] for r in model.score(card, [fixed.ID]).select(fixed.ID, "fraud_probability").collect()}
    b = {r[0]: r[1] for r in again.score(card, [fixed.ID]).select(fixed.ID, "fraud_probability").collect()}
    assert a == b and again.names == model.names
    sparse = spark.createDataFrame([(1, {"C1": "8", "note": "z"})], "TransactionID bigint, extras map<string,string>")
    assert sparse.count() == again.score(sparse, [fixed.ID], extras="extras").where("fraud_probability > 0").count()


def test_boosted_trees_learn_the_missing_signal_and_explain_it(spark, card):
    model = models.fit_boosted(card, NUM, CAT, settings={"depth": 3}, trees=5)
    assert models.top_features(model, 1).first().feature in ("C1", "C1_missing")
    assert abs(models.feature_importance(model).agg(F.sum("importance")).first()[0] - 1) < 1e-9
    curve = models.precision_curve(model, {"all": card, "even": card.where("TransactionID % 2 = 0")})
    rows = {(r.part, r.iteration): r.average_precision for r in curve.collect()}
    assert len(rows) == 10
    for n in (1, 3, 5):
        short = models.RiskModel(model.pipeline, model.inputs, boosting.Forest(
            **{c: getattr(model.forest, c)[:n] for c in boosting.Forest.COLUMNS}, width=model.forest.width))
        scored = models.labelled_predictions(short, card)
        want = evaluate.ranking_metrics(scored, "fraud_probability", f"actual_{fixed.TARGET}").first().average_precision
        assert rows["all", n] == pytest.approx(want, abs=1e-12)
    values = explain.tree_attributions(model, card, fixed.ID)
    margin = F.col("base") + F.aggregate("values", F.lit(0.0), lambda a, v: a + v)
    scored = model.score(card, [fixed.ID])
    worst = values.withColumn("p", 1 / (1 + F.exp(-margin))).join(scored, fixed.ID).agg(
        F.max(F.abs(F.col("p") - F.col("fraud_probability")))).first()[0]
    assert worst < 1e-9
    explain.save_attributions(values, model.names, work := work_path(spark, "attributions-test"))
    again, names = explain.load_attributions(spark, work)
    assert names == model.names and again.exceptAll(values.select(*again.columns)).count() == 0
    long = explain.long_attributions(values, model.names, fixed.ID)
    assert long.count() == card.count() * len(model.names)
    assert explain.global_ranking(long, 3).count() == 3
    tops = explain.top_contributors(long, fixed.ID, 2)
    assert tops.groupBy(fixed.ID, "list").count().agg(F.max("count")).first()[0] == 2
    assert tops.where("list = 'positive' AND value <= 0 OR list = 'negative' AND value >= 0").count() == 0
    assert long.where(f"value = 0 AND direction <> '{fixed.TOWARD_LEGITIMATE}'").count() == 0


def test_boosted_model_round_trip_routing_and_contract(spark, card):
    model = models.fit_boosted(card, NUM, CAT, indicators=False, impute=False, trees=4)
    path = work_path(spark, "boosted-test")
    model.save(path)
    again = models.RiskModel.load(spark, path)
    a = {r[0]: r[1] for r in model.score(card, [fixed.ID]).select(fixed.ID, "fraud_probability").collect()}
    b = {r[0]: r[1] for r in again.score(card, [fixed.ID]).select(fixed.ID, "fraud_probability").collect()}
    assert a == b and again.names == model.names == ["TransactionAmt", "C1", "ProductCD"]
    assert np.isnan(vectors(models.PipelineModel(model.transforms), card.where("C1 is null").limit(1), fixed.ID).popitem()[1][1])
    ghost = models.RiskModel(model.pipeline, models._inputs(["TransactionAmt"], CAT), model.forest)
    with pytest.raises(ValueError, match="without an input.*C1"):
        ghost.check()
    one_hot = models.fit_linear(card, NUM, CAT, iterations=5)
    one_hot.check()
    with pytest.raises(ValueError, match="without an input.*ProductCD"):
        models.RiskModel(one_hot.pipeline, models._inputs(NUM, [])).check()


def random_forest(rng, depth, width):
    """Trees of full depth with repeated features on their paths and some leaves above."""
    forest = boosting.Forest.empty(3, depth, width)
    for t in range(3):
        forest.cover[t, 0] = 100.0
        for node in range(2 ** depth - 1):
            if forest.cover[t, node] and (node == 0 or rng.random() < 0.85):
                forest.feature[t, node] = rng.integers(width)
                forest.cut[t, node] = rng.normal()
                forest.missing_left[t, node] = rng.random() < 0.5
                part = rng.uniform(0.2, 0.8)
                forest.cover[t, 2 * node + 1], forest.cover[t, 2 * node + 2] = np.array([part, 1 - part]) * forest.cover[t, node]
        leaf = (forest.feature[t] < 0) & (forest.cover[t] > 0)
        forest.value[t, leaf] = rng.normal(size=leaf.sum())
    return forest


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5, 6])
def test_tree_values_are_shapley_values(depth):
    rng, width = np.random.default_rng(depth), 4
    forest = random_forest(rng, depth, width)
    xs = rng.normal(size=(5, width))
    xs[0, 1] = np.nan

    def expected(t, x, known, at=0):
        f = forest.feature[t, at]
        if f < 0:
            return forest.value[t, at]
        if f in known:
            left = forest.missing_left[t, at] if np.isnan(x[f]) else x[f] < forest.cut[t, at]
            return expected(t, x, known, 2 * at + 2 - left)
        return sum(forest.cover[t, c] / forest.cover[t, at] * expected(t, x, known, c) for c in (2 * at + 1, 2 * at + 2))

    got = sum(explain._tree_values(xs, forest, t, explain._walk_of(forest.feature[t], forest.cover[t])) for t in range(3))
    assert explain.expected_margin(forest) == pytest.approx(sum(expected(t, xs[0], set()) for t in range(3)))
    for x, row in zip(xs, got):
        for i in range(width):
            rest = [j for j in range(width) if j != i]
            want = sum(
                math.factorial(k) * math.factorial(width - 1 - k) / math.factorial(width)
                * (expected(t, x, {*some, i}) - expected(t, x, set(some)))
                for t in range(3) for k in range(width) for some in itertools.combinations(rest, k))
            assert row[i] == pytest.approx(want, abs=1e-9)


def test_prepare_and_judge(spark, card):
    identity = card.where("TransactionID % 4 = 0").select("TransactionID", F.lit("mobile").alias("DeviceType"))
    data = risk.prepare(spark, card, identity, work_path(spark, "prepared-test"))
    sizes = {r.split: r["count"] for r in data.groupBy("split").count().collect()}
    assert sizes == {"train": 630, "valid": 135, "test": 135}
    model = models.fit_linear(risk.part(data, "train"), NUM, [*CAT, "DeviceType"], iterations=20)
    out = risk.judge(model, data)
    assert out.count() == 6
    assert out.where("true_positives + false_positives + true_negatives + false_negatives <> 135").count() == 0


def test_boosted_fits_take_the_full_number_of_trees():
    import inspect
    assert inspect.signature(models.fit_boosted).parameters["trees"].default == fixed.TREES == 1000
    assert "trees" not in fixed.BOOSTED and "trees" not in fixed.REGULARISED


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_looked_up_values_equal_the_walk(depth):
    """With features that return on a path, missing values and bare roots."""
    rng = np.random.default_rng(depth)
    forest = boosting.Forest.empty(4, depth, 5)
    forest.cover[:, 0] = 100.0
    for t in range(3):
        for node in range(2 ** depth - 1):
            if forest.cover[t, node] and (node == 0 or rng.random() < 0.85):
                part = rng.uniform(0.1, 0.9)
                forest.feature[t, node], forest.cut[t, node] = rng.integers(5), rng.normal()
                forest.missing_left[t, node] = rng.random() < 0.5
                forest.cover[t, 2 * node + 1:2 * node + 3] = forest.cover[t, node] * np.array([part, 1 - part])
    forest.value[:] = np.where((forest.cover > 0) & (forest.feature < 0), rng.normal(size=forest.value.shape), 0.0)
    x = rng.normal(size=(300, 5))
    x[rng.random(x.shape) < 0.2] = np.nan
    for t in range(4):
        want = explain._tree_values(x, forest, t, explain._walk_of(forest.feature[t], forest.cover[t]))
        assert explain._looked_up(x, forest, t, *explain._path_tables(forest, t)) == pytest.approx(want, abs=1e-12)


def test_preparing_joins_once(spark, monkeypatch):
    """The passes that find the cuts read the transactions, not the join; rows and parts are those of the joined table."""
    rows = [(i, (i * 37) % 50, float(i), i % 2) for i in range(200)]
    transactions = spark.createDataFrame(rows, f"{fixed.ID} bigint, {fixed.TIME} bigint, TransactionAmt double, {fixed.TARGET} int")
    identity = spark.createDataFrame([(i, f"d{i}") for i in range(0, 200, 3)], f"{fixed.ID} bigint, DeviceInfo string")
    seen, real = [], risk.split.temporal_split
    monkeypatch.setattr(risk.split, "temporal_split", lambda df, *more: (seen.append(df), real(df, *more))[1])
    got = risk.prepare(spark, transactions, identity, work_path(spark, "prepared-test"))
    assert len(seen) == 1 and "Join" not in seen[0]._jdf.queryExecution().toString()
    monkeypatch.undo()
    want = real(risk.joins.join_one_to_one(transactions, identity, fixed.ID), fixed.TIME, fixed.ID)
    assert sorted(got.columns) == sorted(want.columns)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == 200
    with pytest.raises(Exception):
        risk.prepare(spark, transactions, identity.unionAll(identity), work_path(spark, "prepared-test"))


def test_rows_share_a_trees_tables(spark, monkeypatch):
    """Batches are put together, so that a tree's tables are made once for many rows; chunks and gaps change no value."""
    rng = np.random.default_rng(11)
    forest = boosting.Forest.empty(1, 6, 4)
    forest.feature[0, :63] = rng.integers(0, 3, 63)
    forest.cut[0], forest.missing_left[0] = rng.normal(size=127), rng.random(127) < 0.5
    forest.cover[0] = 1.0 / 2 ** np.floor(np.log2(np.arange(127) + 1))
    forest.value[0, 63:] = rng.normal(size=64)
    upper, groups = explain._path_tables(forest, 0)
    assert len(upper) == 7 and len(groups) == 8 and all(table.shape[1] == 1024 for *_, table in groups)
    x = np.where(rng.random((500, 4)) < 0.2, np.nan, rng.normal(size=(500, 4)))
    want = explain._tree_values(x, forest, 0, explain._walk_of(forest.feature[0], forest.cover[0]))
    assert explain._looked_up(x, forest, 0, upper, groups) == pytest.approx(want, abs=1e-12)
    batches = [pd.DataFrame({"x": range(n)}) for n in (3, 0, 4, 5, 1)]
    assert [len(b) for b in explain._gathered(batches, 6)] == [7, 6]
    assert pd.concat(explain._gathered(batches, 6)).x.tolist() == pd.concat(batches).x.tolist()
