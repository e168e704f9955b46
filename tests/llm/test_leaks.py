import random

import pytest

from cardwarden.llm import leaks


def plain(text):
    return leaks.plain_words((text or "").encode())


def distance(item, region):
    """Least edits of the item to any stretch, by the plain table."""
    row = [0] * (len(region) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(region, 1):
            new.append(min(row[j - 1] + (w != v), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(docs, items):
    out = set()
    for d, text in docs:
        for i, t in items:
            words = plain(t)
            if len(words) >= leaks.MIN_WORDS and (e := distance(words, plain(text))) <= len(words) // 5:
                out.add((d, i, e))
    return out


def edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        new = f"new{rng.randrange(10 ** 6)}"
        words[at:at + 1] = [[], [new], [words[at], new]][kind]
    return words


def test_least_edits_equals_table():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.choice("abcd") for _ in range(rng.randint(1, 12))]
        region = [rng.choice("abcde") for _ in range(rng.randint(0, 20))]
        assert leaks.least_edits(item, region) == distance(item, region)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(5, 60)))) for i in range(60)]
    rows += [(100, "the of the of the of the of the"), (101, "short one"), (102, None), (103, ""), (104, rows[0][1])]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_recall_and_precision_against_brute_force(spark, items):
    rng = random.Random(7)
    own = [(r.item_id, r.text) for r in items.collect()]
    docs = []
    for n in range(600):
        body = [f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 150))]
        if n % 2:
            words = own[rng.randrange(60)][1].split()
            at = rng.randint(0, len(body))
            body[at:at] = edited(rng, words, rng.randint(0, len(words) // 5))
        docs.append((n, " ".join(body).replace("w1 ", "W1, ")))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = brute(docs, own)
    got = {(r.doc_id, r.item_id, r.edits) for r in leaks.leaked(df, items).collect()}
    assert {x[:2] for x in got} <= {x[:2] for x in want}
    assert len({x[:2] for x in got}) >= 0.98 * len({x[:2] for x in want})
    exact = {x[:2] for x in want if not x[2]}
    assert exact <= {x[:2] for x in got} and len(want) > 250


def test_real_benchmark(spark, sample_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs, own = [(r.doc_id, r.text) for r in sample_docs.collect()], [(r.item_id, r.text) for r in bench.collect()]
    got = {(r.doc_id, r.item_id) for r in leaks.leaked(sample_docs, bench).collect()}
    want = {(d, i) for d, t in docs for i, x in own if t and x in t}
    assert want and want <= got
    kept = leaks.without_leaks(sample_docs, bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in got}
    assert kept.columns == sample_docs.columns


def test_edge_rows_and_blocks(spark, items, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_ITEMS", 7)
    text = items.where("item_id = 0").first().text
    df = spark.createDataFrame([(1, None), (2, ""), (3, "short one"), (None, text), (4, "x " * 50_000 + text), (4, text), (5, "the of " * 3)],
                               "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.item_id) for r in leaks.leaked(df, items).collect())
    assert got == [(0, 0), (0, 104), (4, 0), (4, 0), (4, 104), (4, 104)]
    assert sorted(r.doc_id or 0 for r in leaks.without_leaks(df, items).collect()) == [1, 2, 3, 5]
    assert leaks.leaked(df, items.limit(0)).count() == 0 and leaks.leaked(df.limit(0), items).count() == 0
    assert leaks.without_leaks(df, items.limit(0)).count() == 7
