import math
import random

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import balance


def brute_targets(sizes):
    """sizes: source -> words, sources in code point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        want = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if want[s] > 3 * sizes[s]]
        if not over:
            return {**{s: 3 * sizes[s] for s in capped}, **want}
        capped.update(over)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * rng.choice([0, 3, 40, 200, 5000 if i % 50 == 0 else 90])), rng.choice(["a", "a", "a", "B", "é", None, "tiny"]))
            for i in range(3000)]
    rows += [(10_000 + i, "same size words here", "a") for i in range(1500)]
    rows += [(20_000, None, "void"), (20_001, "", "void"), (None, "one two", "a"), (None, "one two", "a")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


@pytest.fixture(scope="module")
def mix(docs, folder):
    return [r.asDict() for r in balance.mixed(docs, carry=True).collect()]


def test_targets_and_sizes(docs, mix):
    assert len(mix) == docs.count()
    sizes = {}
    for r in mix:
        assert r["size"] == len((r["text"] or "").split())
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    want = brute_targets(sizes)
    for r in mix:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-12, abs_tol=1e-9)


def test_taken_words_meet_the_targets(mix):
    taken = {}
    for r in mix:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert abs(r["copies"] - r["rate"]) < 2 or not r["size"]
        t = taken.setdefault(r["source"], [0, r["target"]])
        t[0] += r["taken"]
    for got, target in taken.values():
        assert abs(got - target) <= 0.002 * target + 5


def test_rates_are_tilted_exponentials(mix):
    by = {}
    for r in mix:
        if r["size"] and r["rate"] < 3:
            by.setdefault(r["source"], set()).add((r["size"], r["rate"]))
    for pairs in by.values():
        slopes = [math.log(w) / s for s, w in pairs if s < 4096]
        assert max(slopes) - min(slopes) < 1e-6 * max(1e-3, abs(slopes[0])) + 1e-12


def test_rerun_agrees(docs, folder, mix):
    again = balance.mixed(docs.repartition(7))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    assert sorted([(key(r.asDict()), r["taken"]) for r in again.collect()]) == sorted([(key(r), r["taken"]) for r in mix])


def test_empty_and_clashing(docs, folder):
    assert balance.mixed(docs.limit(0)).count() == 0
    assert balance.mixed(docs.where("source = 'void'")).agg(F.sum("taken")).first()[0] == 0
    wide = docs.limit(50).withColumn("size", F.lit("x")).withColumn("tokens", F.lit(1)).withColumn("docs", F.lit(2)).withColumn(
        "__m", F.create_map(F.lit(1), F.lit(2)))
    assert balance.mixed(wide, carry=True).where("size >= 0").count() == 50
