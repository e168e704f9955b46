import random

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import chats


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    convs = {c: tuple((r, t) for _, r, t in sorted(v)) for c, v in convs.items()}
    out = {}
    for c, v in convs.items():
        same = [o for o, w in convs.items() if w == v]
        if any(len(w) > len(v) and w[:len(v)] == v for w in convs.values()):
            continue
        if c != min(same, key=lambda x: (x is None, x or 0)):
            continue
        out[c] = (len(v), len(same), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for (_, r), (_, t) in v))
    return out


def check(df, rows):
    got = {}
    for r in sorted(chats.maximal(df).collect(), key=lambda r: r.part):
        turns, copies, chat = got.get(r.conv_id, (r.n_turns, r.n_snapshots, ""))
        got[r.conv_id] = (turns, copies, chat + r.chat)
    assert got == brute(rows)


def test_given_conversations(spark, folder):
    df = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    check(df, [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


@pytest.mark.parametrize("block", [3, 1024])
def test_snapshots(spark, folder, monkeypatch, block):
    monkeypatch.setattr(chats, "BLOCK", block)
    rng, rows = random.Random(block), []
    whole = [[(k, rng.choice(["user", "assistant"]), f"t{rng.randrange(4)}") for k in range(rng.randint(1, 12))] for _ in range(15)]
    for c in range(60):
        full = rng.choice(whole)
        rows += [(c, *t) for t in full[:rng.randint(1, len(full))]]
    rows += [(100, None, "user", "x"), (100, 5, None, None), (100, 5, "user", ""), (101, 7, None, None), (101, 9, None, ""),
             (None, 0, "user", "alone"), (102, -4, "user", "t0"), (103, 10, "user", "t0"), (104, 1, "a", "same"), (104, 1, "a", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("place", F.lit("clash"))
    check(df.repartition(4), rows)
    assert chats.maximal(df.limit(0)).count() == 0
