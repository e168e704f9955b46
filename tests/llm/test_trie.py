import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardwarden.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_hand(rows):
    """Every node by listing all prefixes of all rebuilt conversations."""
    convs: dict = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(convs.get(c - rest, [])[:h] + own[h:])
    members: dict = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    kids: dict = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def under(p):
        yield p
        for k in kids.get(p, []):
            yield from under(k)

    out = []
    for p, m in members.items():
        sub = list(under(p))
        ends = sorted(c for c in m if len(rebuilt[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])),
                    sum(not kids.get(s) for s in sub),
                    sum((len(members[s]) - 1) * len(s[-1][1].encode()) for s in sub if s),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = sorted(map(tuple, trie.nodes(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert got == by_hand(rows)
    return got


def random_rows(seed, convs=60, most=9, words=2):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.integers(1, most)):
            rows.append((c, t, ["user", "bot"][t % 2], "é" * int(rng.integers(words)) + "x"))
    return rows


@pytest.mark.parametrize("cells", [1, 12, 60, 1 << 20])
def test_equals_listing_all_prefixes(spark, monkeypatch, cells):
    """Also with shards of one row or a few, where most nodes lie in several shards."""
    monkeypatch.setattr(trie, "CELLS", cells)
    for seed in range(2):
        check(spark, random_rows(seed))


def test_long_shared_prefixes_copies_and_range_ties(spark, monkeypatch):
    monkeypatch.setattr(trie, "CELLS", 90)
    monkeypatch.setattr(trie, "RANGE_TURNS", 2)
    rows = []
    for c in range(0, 200, 5):  # stems graft only on themselves
        turns = 1 + (c % 25) * 2
        rows += [(c, t, "u", "same" if t < 40 else f"own {c}") for t in range(turns)]
    rows += [(c, t, "u", "copy") for c in range(200, 400, 5) for t in range(3)]
    got = check(spark, rows)
    assert max(r[3] for r in got) == 80


def test_nulls_ties_repeats_and_turnless(spark):
    rows = [(0, None, "u", "first"), (0, 1, None, None), (0, 1, "u", None), (0, 1, None, "b"), (0, 1, None, "b"),
            (1, 0, "u", "a"), (2, 0, "u", "a"), (3, 0, "u", "a"), (4, 0, "u", "a"), (7, 0, "u", "x"), (8, 3, "u", "x"),
            (-4, 0, "u", "neg"), (-5, 0, "v", "neg"), (-5, 1, "v", "more"), (None, 0, "u", "lost"), (6, 5000, "u", "far"),
            (6, 2, "u", "near"), (6, None, "u", None)]
    got = check(spark, rows)
    assert any(r[1] == 0 for r in got)
    assert any(r[7] != trie.NO_ENDS for r in got if r[1] == 0)  # conversations without a turn end at the root


def test_single_conversation_extra_columns_and_empty_table(spark):
    check(spark, [(5, 0, "u", "only")])
    df = spark.createDataFrame([(5, 0, "u", "a")], SCHEMA).withColumns({"ids": F.lit(1), "key": F.lit("k"), "place": F.lit(2), "block": F.lit(3)})
    assert trie.nodes(df).count() == 2
    assert trie.nodes(df.where("false")).count() == 0


def test_one_long_conversation_and_long_texts(spark):
    rows = [(10, t, "u", "y" * 50_000 if t == 3 else str(t)) for t in range(3000)] + [(15, t, "u", str(t)) for t in range(3)]
    got = trie.nodes(spark.createDataFrame(rows, SCHEMA)).collect()
    # 0, 1 and 2 are shared; the long one goes on alone.
    assert len(got) == 1 + 3000 and {r.n_convs for r in got} == {1, 2}
    assert next(r for r in got if r.depth == 0).saved_tokens == 3
    assert next(r for r in got if r.depth == 3).n_children == 1
