import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import lm

def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def tokens(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w] + [None]


def brute(rows, order, prior):
    """The same model by recursion over counted tuples."""
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    counts = Counter()
    for k, text in rows:
        t = tokens(text)
        if not held[k]:
            counts.update(tuple(t[i:i + n]) for n in range(1, order + 1) for i in range(len(t) - n + 1))
    total = sum(c for g, c in counts.items() if len(g) == 1)
    types = sum(len(g) == 1 for g in counts)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 1) / (total + types + 1)
        return (counts[gram] + prior * p(gram[1:])) / (counts[gram[:-1]] + prior)

    out = {}
    for k, text in rows:
        t = tokens(text)
        base = sum(math.log10((counts[(w,)] + 1) / (total + types + 1)) for w in t)
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1):i + 1]))) for i in range(len(t)))
        out[k] = (held[k], len(t), sum(counts[(w,)] > 0 for w in t), total, base, score)
    return out


def check(spark, rows, order, prior):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = brute(rows, order, prior)
    got = lm.scored(df, held_out(), order=order, prior=prior).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4], r
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9) and math.isclose(r.score, w[5], rel_tol=1e-9), r


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, folder, monkeypatch, order):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 300)
    monkeypatch.setattr(lm, "LANE", 7)
    rng = random.Random(order)
    rows = [(i, " ".join(rng.choice("aAbcdeé,x") for _ in range(rng.choice([0, 1, 2, 30, 400])))) for i in range(60)]
    check(spark, rows + [(900, None), (901, ""), (902, " \n "), (903, "zz " * 2000)], order, 2.5)


def test_documents(spark, folder, sample_docs):
    check(spark, [(r.doc_id, r.text) for r in sample_docs.collect()], lm.ORDER, lm.PRIOR)


def test_next_words_are_a_distribution(spark, folder):
    """Held-out one-word texts: probabilities of all words, the end and the unknown word add up to 1."""
    train = [(k, "a b a c a b") for k in range(50) if zlib.crc32(str(k).encode()) % 7 != 2]
    held = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 7 == 2]
    asked = ["a a", "a b", "a c", "a", "a unknown"]
    got = {r.doc_id: r.score for r in lm.scored(
        spark.createDataFrame(train + list(zip(held, [*asked, "b", "c", "unknown"])), "doc_id bigint, text string"), held_out()).collect()}
    score = dict(zip([*asked, "b", "c", "unknown"], (got[k] for k in held)))
    end = {w: 10 ** score[w] for w in ("a", "b", "c", "unknown")}
    assert all(0 < v < 1 for v in end.values())
    after_a = sum(10 ** score[f"a {w}"] for w in ("a", "b", "c", "unknown"))
    assert after_a < 10 ** score["a"] + 1


def test_model_beats_unigrams_on_held_out_text(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.scored(docs, held_out()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_empty_and_all_held(spark, folder):
    df = spark.createDataFrame([(1, "a b"), (2, None), (None, "a"), (2, None)], "doc_id bigint, text string")
    assert lm.scored(df.limit(0), held_out()).count() == 0
    got = lm.scored(df, F.lit(True)).collect()
    assert len(got) == 4 and all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in got)
