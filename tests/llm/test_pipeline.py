import pytest

import corpus_pipeline
from cardwarden.llm import secrets
from tests.llm import test_balance, test_host_rules, test_leaks, test_near, test_secrets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, folder):
    """What each stage kept, every stage on the rows of the one before."""
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        kept.append((docs.collect(), out.collect()))
        docs = spark.createDataFrame(kept[-1][1], out.schema)
    return kept


def test_quality_rules(stages):
    before, after = stages[0]
    good = set()
    for r in before:
        m = test_host_rules.brute(r.text)
        if m["n_words"] >= 20 and 100 * m["n_repeat_words"] <= 30 * m["n_words"]:
            good.add(r)
    assert set(after) == good and after[0].__fields__ == COLUMNS  # no host of this table fails beyond doubt


def test_near_duplicates(stages):
    before, after = stages[1]
    want, _ = test_near.brute_kept([(r.doc_id, r.text) for r in before])
    assert {r.doc_id for r in after} == want and len(after) == len(want) and set(after) <= set(before)


def test_decontamination(spark, stages):
    before, after = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, _, _ in test_leaks.brute([(r.doc_id, r.text) for r in before], items)}
    assert {r.doc_id for r in after} == {r.doc_id for r in before} - dirty and set(after) <= set(before)


def test_secrets_masked(stages):
    before, after = stages[3]
    assert [r.doc_id for r in sorted(before)] == [r.doc_id for r in sorted(after)]
    old = {r.doc_id: r for r in before}
    for r in after:
        assert not test_secrets.brute(r.text)
        if not secrets.secret_spans(old[r.doc_id].text, test_secrets.VOCABULARY):
            assert r == old[r.doc_id]
        else:
            assert r.text != old[r.doc_id].text and r.n_chars == len(r.text)


def test_balanced(stages):
    before, after = stages[4]
    sizes, taken, least = {}, {}, {}
    for r in before:
        size = len(r.text.split())
        sizes[r.source] = sizes.get(r.source, 0) + size
        least[r.source] = min(size, least.get(r.source, size))
    for r in after:
        assert 1 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, target in test_balance.brute_targets(sizes).items():
        assert abs(taken.get(source, 0) - target) <= least[source] / 2 + 0.001 * target


def test_run_gives_the_last_stage(spark, folder, stages):
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r.doc_id for r in stages[4][1])


def test_stages_take_odd_rows(spark, folder, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a word or two " * 9, "xx", "s", None),
            (None, " ".join(f"w{i}" for i in range(50)), None, None, 1), (None, " ".join(f"w{i}" for i in range(50)), None, None, 1),
            (3, " ".join(f"w{i}" for i in range(50)), None, None, 1), (4, " ".join(f"v{i}" for i in range(30_000)), "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for table in (docs, docs.limit(0)):
        table.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        spark.read.parquet(f"{SF}/benchmark.parquet").limit(0 if table is not docs else 5).write.mode("overwrite").parquet(f"{tmp_path}/benchmark.parquet")
        out = corpus_pipeline.run(spark, str(tmp_path)).collect()
        assert {r.doc_id for r in out} <= {3, 4} and len(out) == len({r.doc_id for r in out})
