import hashlib
import tracemalloc

import pyarrow as pa
import pytest

from cardwarden.llm import infill


def by_hand(key, text):
    """Output and facts straight from the rules."""
    text = text or ""
    h = hashlib.sha256(f"1:{key if key is not None else ''}".encode()).hexdigest()
    a, b, c, d = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not n or "<P>" in text or "<S>" in text or "<M>" in text or c % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((a % (n + 1), b % (n + 1)))
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if d % 100 < 20:
        return n, "spm", i, j - i, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", i, j - i, f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [None, "", "a", "<", "<<P", "é😀" * 9, "with <M> inside", "<P", "M>" * 40, "x" * 5000, "ß\n\x00\t" * 333]


@pytest.mark.parametrize("unit", [1, 7, 65_536])
def test_equals_the_rules(spark, unit):
    rows = [(k, t) for k in [*range(-3, 25), None] for t in TEXTS] + [(7, "twice twice")] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, infill.transformed(df, unit=unit).collect()), key=repr)
    want = []
    for k, t in rows:
        n, form, prefix, middle, out = by_hand(k, t)
        want.append((k, n, form, prefix, middle, sha(out), sha(t or "")))
    assert got == sorted(want, key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_pieces_put_together_are_the_output(spark):
    df = spark.createDataFrame([(k, "word " * 50 + str(k)) for k in range(30)], "doc_id bigint, text string")
    found: dict = {}
    for r in infill.sent(df, unit=16).collect():
        if r.place == infill.HEAD:
            found[r.uid] = [int(r.doc_key), ""]
        else:
            found[r.uid][1] += bytes(r.data).decode()
    assert dict(found.values()) == {k: by_hand(k, "word " * 50 + str(k))[4] for k in range(30)}


def test_long_text_text_keys_extra_columns_and_empty_table(spark):
    long = "αβγ " * 1_000_000
    df = spark.createDataFrame([("k1", long, "x", 1), ("k2", "b", "y", 2)], "doc_id string, text string, uid string, place int")
    got = {r.doc_id: r for r in infill.transformed(df).collect()}
    n, form, prefix, middle, out = by_hand("k1", long)
    assert (got["k1"].n, got["k1"].form, got["k1"].prefix_chars, got["k1"].output_sha256) == (n, form, prefix, sha(out))
    assert got["k1"].restored_sha256 == sha(long)
    assert infill.transformed(df.where("false")).count() == 0


def test_bytes_that_are_no_text_come_back(spark):
    df = spark.sql("select 3L as doc_id, cast(unhex('41FF42C3') as string) as text")
    assert infill.transformed(df).first().restored_sha256 == hashlib.sha256(bytes.fromhex("41FF42C3")).hexdigest()


def test_a_batch_of_pieces_is_not_held_as_values():
    """2,000 pieces of 10 KB are 20 MB."""
    batch = pa.RecordBatch.from_pydict({"uid": list(range(2000)), "data": [bytes(10_000)] * 2000})
    tracemalloc.start()
    try:
        assert sum(len(data) for _, data in infill._documents([batch])) == 20_000_000
        assert tracemalloc.get_traced_memory()[1] < 4e6
    finally:
        tracemalloc.stop()
