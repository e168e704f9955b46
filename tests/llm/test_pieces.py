import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from cardwarden.llm import pieces


def reference(vocabulary, byte_fallback=True):
    t = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(pieces.BLANK, prepend_scheme="always", split=True)
    return t


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(pieces.DEFAULT_VOCABULARY)


def count(t, text):
    return len(t.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_tokenizer_on_documents(spark, sample_docs, vocabulary):
    t = reference(vocabulary)
    texts = {r.doc_id: r.text for r in sample_docs.collect()}
    for r in pieces.token_counts(sample_docs).collect():
        assert r.n_tokens == count(t, texts[r.doc_id]) and r.n_chars == len(texts[r.doc_id])


def test_counts_equal_the_tokenizer_on_odd_texts(vocabulary):
    t, c = reference(vocabulary), pieces.Counter(vocabulary)
    rng = random.Random(8)
    alphabet = "aabcdetho     \n\t.,é🙂▁中<0x>s/"
    texts = ["", " ", "  ", "▁", "a▁b", " a", "a ", "<unk>", "<s> x", "<0x41>", "🙂🙂 \U0001F9FF", "x" * 5000, "the  the"]
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    assert [c.text(x) for x in texts] == [count(t, x) for x in texts]


def test_ties_follow_the_tokenizer():
    """Whole scores make many paths equal; the counts differ between tie rules."""
    rng = random.Random(3)
    for _ in range(100):
        made = {"<unk>": 0.0, "▁": -1.0}
        for _ in range(14):
            made["".join(rng.choice("ab▁") for _ in range(rng.randint(1, 3)))] = -float(rng.randint(1, 3))
        vocabulary = list(made.items())
        t, c = reference(vocabulary, False), pieces.Counter(vocabulary, byte_pieces=False)
        for _ in range(20):
            text = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 14)))
            assert c.text(text) == count(t, text), (vocabulary, text)


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b")], "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_chars) for r in pieces.token_counts(df).collect())
    assert got[1:3] == [(1, 0, 0), (2, 0, 0)] and got[3] == got[4] and len(got) == 5
    assert pieces.token_counts(df.limit(0)).count() == 0


def test_long_words_take_little_memory(vocabulary):
    import tracemalloc
    counter = pieces.Counter(vocabulary)
    word = "abcdefgé" * 125_000
    tracemalloc.start()
    n = counter.word(pieces.BLANK + word)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 30_000_000 and n == count(reference(vocabulary), word)


def test_clashing_columns_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "one two", 5, "k")], "doc_id bigint, text string, n_tokens int, t string")
    assert pieces.token_counts(df).columns == ["doc_id", "n_tokens", "n_chars"] and pieces.token_counts(df).first().n_chars == 7
    assert pieces.token_counts(df.where("false")).count() == 0
