import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardwarden.llm import host_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def check(rows, got):
    for r in rows:
        want = brute(r["text"])
        mine = [g for g in got if g["doc_id"] == r["doc_id"]]
        assert mine and all({k: g[k] for k in want} == want for g in mine), r["doc_id"]
        failed = want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"]
        assert all(g["base_failed"] == failed for g in mine)


def test_measures_equal_brute_force_on_documents(spark, folder, sample_docs):
    rows = [r.asDict() for r in sample_docs.collect()]
    check(rows, [r.asDict() for r in host_rules.judged(sample_docs).collect()])


def test_edge_texts(spark, folder):
    rng = random.Random(1)
    texts = [None, "", " \n\t ", "a", "\n\na\na\n", "x " * 9, "é ñ ü #$|", "a b c d e f g h " * 3 + "tail",
             " ".join(rng.choice("ab") for _ in range(60)), "word " * 30_000, "  \x1c a\x00b"]
    rows = [{"doc_id": i, "text": t, "source": "s"} for i, t in enumerate(texts)]
    rows.append(rows[3])
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = [r.asDict() for r in host_rules.judged(df).collect()]
    assert len(got) == len(rows)
    check(rows, got)


@pytest.fixture(scope="module")
def hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(40)), "short"
    rows = [(i, good if i % 20 else bad, "fine") for i in range(200)]
    rows += [(1000 + i, bad if i < 95 else good, "rotten") for i in range(100)]
    rows += [(2000, good, "tiny"), (2001, bad, "tiny2"), (3000, good, None), (3001, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def test_only_a_host_that_fails_beyond_doubt_is_rejected(spark, folder, hosts):
    got = {r.doc_id: r for r in host_rules.judged(hosts).collect()}
    assert not got[1099].base_failed and not got[1099].kept and got[1099].host_rejected
    assert got[1].kept and got[2000].kept and got[3000].kept
    assert not got[0].kept and not got[2001].kept and not got[3001].kept
    assert got[3000].host_docs is None and not got[2001].host_rejected


def test_keep_returns_the_kept_rows_unchanged(spark, folder, hosts):
    wide = hosts.withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(1)).withColumn("__m", F.create_map(F.lit(1), F.lit(2)))
    kept = host_rules.keep(wide)
    assert kept.columns == wide.columns
    want = {r.doc_id for r in host_rules.judged(hosts).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_empty_table(spark, folder, hosts):
    assert host_rules.judged(hosts.limit(0)).count() == 0
    assert host_rules.keep(hosts.limit(0)).count() == 0
