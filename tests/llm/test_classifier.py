import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import classifier

SF = "/root/testdata/sf0.1"


def held(key="doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1


def auc(rows):
    pos, neg = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    return np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    out = classifier.judged(docs, labels, held())
    assert out.count() == docs.count()
    rows = out.where("held_out").join(labels, "doc_id").select("quality", "score", "predicted").collect()
    assert len(rows) > 1000
    assert auc(rows) > 0.9
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
    assert out.where("predicted <> cast(score >= 0.5 as int) or not score between 0 and 1").count() == 0


def test_updates_follow_the_regularised_leader():
    """The closed form: every weight minimises the linear sums, the proximal terms and both penalties."""
    rng = np.random.default_rng(2)
    leader = classifier.Leader.empty(4)
    linear, strength, centre = np.zeros(17), np.zeros(17), np.zeros(17)
    squares = np.zeros(17)
    for _ in range(40):
        slots = np.sort(rng.choice(17, 5, replace=False))
        values, label = rng.normal(size=5), float(rng.integers(2))
        w = leader.weights()
        g = np.zeros(17)
        g[slots] = 1.5 * (classifier.probability(w[slots] @ values) - label) * values
        sigma = (np.sqrt(squares + g * g) - np.sqrt(squares)) / classifier.STEP
        squares += g * g
        linear += g
        strength += sigma
        centre += sigma * w
        leader.learn(slots, values, label, 1.5)
        got = leader.weights()
        quadratic = strength + classifier.BETA / classifier.STEP + classifier.L2
        z = linear - centre
        want = np.where(np.abs(z) <= classifier.L1, 0, -(z - np.sign(z) * classifier.L1) / quadratic)
        assert got == pytest.approx(want)


def test_parts_are_averaged(spark):
    text = ["good day", "good night", "bad !!! day", "bad ### night"] * 10
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(text)], "doc_id bigint, text string, label string")
    labels = spark.createDataFrame([(i, int(t.startswith("good"))) for i, t in enumerate(text)], "doc_id bigint, quality int")
    none = F.lit(False)
    weights = classifier.fit(docs, labels, none, bits=10, epochs=2, rows_per_part=10)
    rows = classifier.labelled_rows(docs, labels, none, "doc_id", "text", "quality", 10)
    leader = classifier.Leader.empty(10)
    for epoch in range(2):
        placed = rows.repartition(4, "order").sortWithinPartitions(F.xxhash64("order", F.lit(epoch)), "order", "label")
        parts = [p for p in placed.rdd.glom().collect() if p]
        states = []
        for part in parts:
            mine = classifier.Leader(leader.z.copy(), leader.n.copy())
            for r in part:
                mine.learn(*classifier.unpacked(bytes(r.slots), bytes(r.counts), 10), r.label, 1.0)
            states.append(mine)
        leader = classifier.Leader(np.mean([s.z for s in states], axis=0), np.mean([s.n for s in states], axis=0))
    assert len(parts) > 1 and weights == pytest.approx(leader.weights())
    assert weights.tolist() == classifier.fit(docs, labels, none, bits=10, epochs=2, rows_per_part=10).tolist()
    out = {r.text: r.score for r in classifier.scored(docs, weights, none, bits=10).join(docs, "doc_id").collect()}
    assert min(out["good day"], out["good night"]) > 0.5 > max(out["bad !!! day"], out["bad ### night"])


def test_nulls_repeats_clashes_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "good", "a"), (1, "good", "a"), (2, None, "b"), (3, "", "c"), (None, "bad", None), (4, "w " * 200_000, "d")],
        "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 0), (None, 1), (9, 1)], "doc_id bigint, quality int")
    out = classifier.judged(docs, labels, held()).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert len({r.score for r in out if r.doc_id in (2, 3)}) == 1
    blank = classifier.judged(docs, labels.where("false"), held()).collect()
    assert {(r.score, r.predicted) for r in blank} == {(0.5, 1)}
    assert classifier.judged(docs.where("false"), labels, held()).count() == 0


def test_a_bounded_sample_of_ids_is_learned_from(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "concat('w', id) as text")
    docs = docs.union(docs.where("doc_id < 300"))
    labels = spark.range(400).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    rows = classifier.labelled_rows(docs, labels, F.lit(False), "doc_id", "text", "quality", 8, sample=50)
    every = sorted(r[0] for r in labels.select(F.xxhash64("doc_id")).collect())
    assert sorted(r.order for r in rows.collect()) == every[:50]


def test_tokens_and_slots():
    assert classifier.TOKEN.findall(b"the*** a-b !! \xc3\xa9") == [b"the", b"***", b"a", b"-", b"b", b"!!", b"\xc3\xa9"]
    slots, values = classifier.sparse(b"One one TWO", 12)
    again, _ = classifier.sparse(b"one ONE two", 12)
    assert slots.tolist() == again.tolist() and slots[-1] == 1 << 12
    assert (values[:-1] ** 2).sum() == pytest.approx(1) and len(slots) == 5  # one, two, one one, one two and the constant
    assert classifier.sparse(None)[0].tolist() == [1 << classifier.BITS]
