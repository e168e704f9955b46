import random
import tracemalloc
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import near

WORDS = [f"w{i}" for i in range(4000)]


def sets(text, size=5):
    """Shingles from the words themselves."""
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute_kept(rows, least=0.8):
    """Keys that stay when every pair of texts is compared, and the links."""
    found = [sets(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    links = []
    for i in range(len(rows)):
        for j in range(i):
            a, b = found[i], found[j]
            if (not a and not b) or (a and b and len(a & b) / len(a | b) >= least):
                links.append((i, j))
                root[top(i)] = top(j)
    best = {}
    for i, (k, _) in enumerate(rows):
        best[top(i)] = min(best.get(top(i), k), k)
    return set(best.values()), links


def changed(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS)
    return words


def corpus(seed, texts=150, low=60, high=400):
    """Texts, copies with single words replaced, and unrelated ones."""
    rng = random.Random(seed)
    out = []
    for _ in range(texts):
        words = rng.choices(WORDS, k=rng.randint(low, high))
        out.append(words)
        for _ in range(rng.choice([0, 0, 1, 2])):
            out.append(changed(rng, words, rng.randint(0, max(1, len(words) // 40))))
    rng.shuffle(out)
    return [(i, " ".join(w)) for i, w in enumerate(out)]


@pytest.fixture(scope="module")
def frame(spark, folder):
    return lambda rows, kind="bigint": spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)


def test_recall_against_every_pair(frame):
    rows = corpus(3)
    want, links = brute_kept(rows)
    got = {r.doc_id for r in near.one_of_each(frame(rows)).collect()}
    gone, should = {k for k, _ in rows} - got, {k for k, _ in rows} - want
    assert gone <= should and len(gone) >= 0.95 * len(should) and len(links) > 60


def test_recall_close_to_the_least_similarity(frame):
    """Pairs between 0.8 and 0.85 alone."""
    rng, rows = random.Random(8), []
    while len(rows) < 300:
        words = rng.choices(WORDS, k=200)
        other = changed(rng, words, 5)
        a, b = sets(" ".join(words)), sets(" ".join(other))
        if 0.8 <= len(a & b) / len(a | b) < 0.85:
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    kept = near.one_of_each(frame(rows)).count()
    assert 150 <= kept <= 150 + 15


def test_real_documents(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, _ = brute_kept(rows)
    got = {r.doc_id for r in near.one_of_each(docs).collect()}
    should = {k for k, _ in rows} - want
    assert want <= got and len(got - want) <= 0.1 * len(should)


def test_large_groups_of_loose_copies_and_short_lists(frame, monkeypatch):
    monkeypatch.setattr(near, "LIST_ROWS", 16)
    monkeypatch.setattr(near, "BLOCK_ROWS", 64)
    rng = random.Random(2)
    base = rng.choices(WORDS, k=200)
    rows = [(i, " ".join(changed(rng, base, 2))) for i in range(300)] + [(1000 + i, " ".join(rng.choices(WORDS, k=80))) for i in range(50)]
    assert {r.doc_id for r in near.one_of_each(frame(rows)).collect()} == {0, *range(1000, 1050)}


def test_text_keys_nulls_short_texts_and_repeats(spark, frame):
    rows = [("b2", "one two three"), ("a1", "ONE  two\nthree"), ("c3", "one two four"), ("d", None), ("e", ""), ("f", " \t"),
            (None, "one two three"), (None, "lonely text"), (None, "lonely text"), ("g", "x y"), ("g", "x y"), ("g", "p q r")]
    got = sorted(map(tuple, near.one_of_each(frame(rows, "string")).collect()), key=repr)
    assert [r for r in got if r[0] != "g"] == sorted(
        [("a1", "ONE  two\nthree"), ("c3", "one two four"), ("d", None), (None, "lonely text")], key=repr)
    assert len([r for r in got if r[0] == "g"]) == 1
    df = frame(rows, "string").withColumns({"nid": F.lit(1), "place": F.lit("p"), "key": F.lit(0), "mark": F.lit(2), "id": F.lit("i")})
    assert near.one_of_each(df).columns == df.columns and near.one_of_each(df).count() == len(got)
    assert near.one_of_each(frame(rows, "string").where("false")).count() == 0
    assert near.one_of_each(frame([(Decimal(1), "a b c"), (Decimal(2), "a b c")], "decimal(20,2)")).first().doc_id == 1


def test_long_texts(frame):
    rng = random.Random(1)
    words = rng.choices(WORDS, k=200_000)
    rows = [(1, " ".join(words)), (2, " ".join(changed(rng, words, 2000))), (3, " ".join(rng.choices(WORDS, k=200_000)))]
    assert {r.doc_id for r in near.one_of_each(frame(rows)).collect()} == {1, 3}


def test_spanning_forest_is_lightest():
    rng = np.random.default_rng(3)
    a, b, w = rng.integers(0, 40, 300), rng.integers(0, 40, 300), rng.integers(0, 50, 300)
    kept = near.spanning(40, a, b, w)
    label, total, count = list(range(40)), 0, 0
    for i in sorted(range(300), key=lambda i: (w[i], a[i], b[i])):
        x, y = label[a[i]], label[b[i]]
        if x != y:
            label = [x if v == y else v for v in label]
            total, count = total + w[i], count + 1
    assert w[kept].sum() == total and len(kept) == count


def test_index_positions():
    few, many = near.index_positions(1000), near.index_positions(1 << 30)
    assert {len(p) for p in few} == {2} and {len(p) for p in many} == {3} and len(few) < len(many)
    assert len(set(few)) == len(few) and max(sum(p in c for c in few) for p in range(32)) <= 2 + 2 * len(few) // 32
    assert near.expected_bits(1.0) == 0 and 0.15 < near.expected_bits(0.8) < 0.16


def test_a_batch_of_texts_is_not_held_as_words():
    """2,000 texts of 4 KB are 8 MB, and 60 MB as lists of words."""
    texts = [" ".join(random.Random(i).choices(WORDS, k=800)) for i in range(2000)]
    batch = pa.RecordBatch.from_pydict({"place": list(range(2000)), "text": texts})
    tracemalloc.start()
    try:
        near._sketches(batch, 5)
        assert tracemalloc.get_traced_memory()[1] < 8e6
    finally:
        tracemalloc.stop()


def test_lists_of_which_a_pair_was_left_out_are_named(monkeypatch):
    monkeypatch.setattr(near, "LIST_ROWS", 4)
    rng = np.random.default_rng(5)
    key = np.repeat([10, 20, 30, 40], [3, 2, 6, 2])
    fp = np.repeat(rng.integers(-2 ** 62, 2 ** 62, (4, 4)), [3, 2, 6, 2], axis=0)
    found = near._block_links(key, np.arange(len(key)), fp).to_pylist()
    # Three alike make a triangle; six are more than a piece; two have one pair.
    assert sorted(r["key"] for r in found if r["key"] is not None) == [10, 30]
    assert len([r for r in found if r["key"] is None]) == 2 + 1 + 5 + 1


def test_what_forests_leave_out_follows(spark, frame, monkeypatch):
    """Without any class yet, every close pair of every list, by cells of two pieces; none inside a class."""
    monkeypatch.setattr(near, "LIST_ROWS", 2)
    docs = frame(corpus(12, texts=60))
    nodes = near.distinct_texts(docs, "doc_id", "text", 5)
    positions = near.index_positions(nodes.count())
    rows = nodes.collect()
    fps = np.array([[r[c] for c in near.FP] for r in rows])
    a, b = np.triu_indices(len(rows), 1)
    ok, _ = near._close(fps, a, b)
    octets = fps.view(np.uint8).reshape(len(rows), -1)
    meet = np.any([np.all([octets[a, p] == octets[b, p] for p in at], axis=0) for at in positions], axis=0)
    nids = [r.nid for r in rows]
    want = {tuple(sorted((nids[i], nids[j]))) for i, j in zip(a[ok & meet], b[ok & meet])}
    lists = near._postings(nodes, positions).select("key").distinct()
    nobody = spark.createDataFrame([], "nid bigint, root bigint")
    got = near.left_out(nodes, nobody, lists, positions)
    assert {tuple(r) for r in got.collect()} == want and len(want) > 20
    some = sorted(want)[0]
    together = spark.createDataFrame([(some[0], some[0]), (some[1], some[0])], "nid bigint, root bigint")
    assert {tuple(r) for r in near.left_out(nodes, together, lists, positions).collect()} == want - {some}


def test_close_texts_that_are_not_alike_make_no_rows_of_pairs(spark, frame, monkeypatch):
    """A group of loose copies: its close pairs grow with its square, what is handed on does not."""
    rng = random.Random(4)
    base = rng.choices(WORDS, k=200)
    rows = [(i, " ".join(changed(rng, base, rng.randint(1, 5)))) for i in range(200)]
    docs = frame(rows)
    nodes = near.distinct_texts(docs, "doc_id", "text", 5)
    positions = near.index_positions(nodes.count())
    lists = near._postings(nodes, positions).select("key").distinct()
    nobody = spark.createDataFrame([], "nid bigint, root bigint")
    every = near.left_out(nodes, nobody, lists, positions).count()
    loose = near.left_out(nodes, nobody, lists, positions, whole=False)
    held = near.components(loose).groupBy("root").count().orderBy("count").collect()
    assert every > 5000 and loose.count() < every / 4 and held[-1]["count"] > 190
    sets_of = near.shingle_sets(loose, nodes, docs, "doc_id", "text", 5)
    for pieces in (1, 8):
        monkeypatch.setattr(near, "PIECES", pieces)
        monkeypatch.setattr(near, "PIECE_ROWS", 4)
        found = near.alike(loose, nodes, nobody, sets_of, 0.8)
        keys = {r.nid: r.place.key for r in nodes.collect()}
        got = {frozenset((keys[r.a], keys[r.b])) for r in found.collect()}
        _, links = brute_kept(rows)
        fps = {r.place.key: np.array([[r[c] for c in near.FP]]) for r in nodes.collect()}
        close = {frozenset((i, j)) for i, j in links if near._close(np.concatenate([fps[i], fps[j]]), np.array([0]), np.array([1]))[0][0]}
        assert got <= close and len(got) < 200 * pieces and len(close) > 10

        def classes(pairs):
            label = {k: k for k, _ in rows}
            for i, j in map(tuple, pairs):
                label = {k: label[i] if v == label[j] else v for k, v in label.items()}
            return len(set(label.values()))
        assert classes(got) == classes(close)
