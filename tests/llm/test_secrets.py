import hashlib
import random
import re
import time

import pytest

from cardwarden.llm import secrets

VOCABULARY = secrets.Vocabulary(secrets.DEFAULT_VOCABULARY)
PATTERNS = [
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def brute(text):
    found = [(m.start(), i, k, m.end()) for i, (k, p, ok) in enumerate(PATTERNS) for m in p.finditer(text or "") if ok(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def check(df):
    rows = {r.doc_id: r.text for r in df.collect()}
    for r in secrets.scan(df).collect():
        want = brute(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [want.count(k + ":") for k in ("assign", "access", "hex")]
        spans = r.spans.split(",") if r.spans else []
        assert set(want.split(",")) - {""} <= set(spans) and len(spans) == r.n_assign + r.n_access + r.n_hex + r.n_random


def test_base_spans_on_documents(spark, sample_docs):
    check(sample_docs)


def test_base_spans_on_edges(spark):
    texts = [None, "", "secret=token : abcdefghijklmnop", "TOKEN = 'aaaaaaaaaaaa'", "paſsword=abcdefghijklmnop", "apiKey=abcdefghijklmnop",
             "AKIA" + "A" * 13, "AKIA" + "A" * 14, "é🙂 AKIA" + "9" * 20, "f" * 15, "f" * 16, "z" * 200_000, "password" * 20_000,
             "api_key: " + "0123456789abcdef" * 2, "password = a token: abcdefghijklmnop"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_random_strings_are_found_and_names_are_not():
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    found = 0
    for _ in range(200):
        run = "".join(rng.choice(letters) for _ in range(32))
        found += secrets.secret_spans(f"see {run} here", VOCABULARY) == [(4, 36, "random")]
    assert found >= 190
    for name in ("d41d8cd98f00b204e9800998ecf8427e".upper(), "123e4567-e89b-12d3-a456-426614174000", "2024-01-01_2024-12-31",
                 "internationalization2009", "my_long_variable_name_number_12", "THE-QUICK-BROWN-FOX-JUMPS-2020", "docs/reference/section12/page",
                 "Donaudampfschifffahrtsgesellschaft", "=" * 80, "-" * 40 + "1"):
        assert not [s for s in secrets.secret_spans(f"see {name} here", VOCABULARY) if s[2] == "random"], name


def test_letters_alone_and_short_keys_are_random_too():
    rng, low, up = random.Random(4), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for letters, n in ((low, 24), (up, 24), (low + up, 24), (low, 40), (low + up, 40), (low + up + "0123456789", 16)):
        runs = ["".join(rng.choice(letters) for _ in range(n)) for _ in range(100)]
        found = sum(secrets.secret_spans(f"see {run} here", VOCABULARY) == [(4, 4 + n, "random")] for run in runs)
        assert found >= 95, (letters, n, found)
    for plain in ("responsibilities", "20240101T120000Z", "internationalization", "z" * 5000, "ACGT" * 10, "XMLHttpRequestFactory", "COVID-19-related-deaths"):
        assert secrets.secret_spans(f"see {plain} here", VOCABULARY) == [], plain


def test_a_key_around_hexadecimal_digits_is_masked_to_its_ends():
    left, right = "Zq7RkXw9PmT2vLs8Yh", "KxW3TqZp9Vr"
    text = f"see {left}0123456789abcdef{right} here"
    assert secrets.redacted(text, secrets.secret_spans(text, VOCABULARY)) in ("see [secret] here", "see [secret][secret][secret] here")
    assert [s[2] for s in secrets.secret_spans("sha256-" + "0123456789abcdef" * 4, VOCABULARY)] == ["hex"]


def test_clean_documents_get_no_random_span(spark, sample_docs):
    texts = [r.text for r in sample_docs.collect()]
    assert sum("random" in s[2] for t in texts for s in secrets.secret_spans(t, VOCABULARY)) == 0


def test_redaction(spark):
    text = "a token = 'abcdefghijkl0123456789abcdef' b AKIA" + "Z" * 16
    df = spark.createDataFrame([(1, text, 5, 9), (2, None, None, 9), (3, "plain", 77, 9)], "doc_id bigint, text string, n_chars bigint, spans int")
    got = {r.doc_id: r for r in secrets.redact(df, length="n_chars").collect()}
    assert got[1].text == "a [secret]' b [secret]" and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars) == (None, None) and (got[3].text, got[3].n_chars) == ("plain", 77)
    assert secrets.redact(df, length="n_chars").columns == df.columns
    assert secrets.scan(df.limit(0)).count() == 0


def test_missing_vocabulary():
    with pytest.raises(FileNotFoundError):
        secrets.Vocabulary("/nowhere")


def _letters(alphabet, n, seed=1):
    return "".join(random.Random(seed).choices(alphabet, k=n))


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "ab", "_-/", "aB1_"])
@pytest.mark.parametrize("tail", ["", "A1b", "z", "Z", "-", "a_B"])
def test_long_runs_of_one_class_take_linear_time(alphabet, tail):
    run = _letters(alphabet, 100_000) + tail
    start = time.perf_counter()
    secrets.secret_spans(run, VOCABULARY)
    assert time.perf_counter() - start < 10


def test_many_spans_take_linear_time():
    digests = [hashlib.md5(str(i).encode()).hexdigest() for i in range(100_000)]
    start = time.perf_counter()
    spans = secrets.secret_spans(" ".join(digests), VOCABULARY)
    assert time.perf_counter() - start < 10
    assert len(spans) == 100_000


@pytest.mark.parametrize("run, named", [
    ("parseHttpRequest", True), ("abcD", False), ("ABCd", False), ("ABcd", True), ("Ab", False), ("Abc", True), ("A", False), ("a", False),
    ("a1", False), ("snake_case_name2024", True), ("x86_64", False), ("2024-01-02", True), ("abX", False), ("abXY", True), ("éa", False)])
def test_name_shapes(run, named):
    assert bool(secrets.NAME.fullmatch(run)) is named


def test_keys_beside_repeated_stretches():
    key = _letters("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 400, 5)
    for filler in ("AB" * 300, "=" * 900, "abcdefgh" * 80):
        assert secrets.secret_spans(filler + key, VOCABULARY) == [(len(filler), len(filler) + 400, "random")]
        assert secrets.secret_spans(key + filler + key, VOCABULARY)[-1][1] == 800 + len(filler)
        assert secrets.secret_spans(filler, VOCABULARY) == []
