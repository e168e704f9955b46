"""Quality rules judged by text and by host.

Every text is measured on its own; the failures are then counted by host, a beta prior is fitted to
the hosts' failure rates by moments, each host's rate is shrunk towards it, and a host whose shrunk
rate lies above the limit beyond doubt takes its remaining texts with it.  Built-in functions only.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.functions.once import once
from cardwarden.llm.common import WHITE, attach, let, row_hash, words_column
from cardwarden.session import materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# A host goes when its rate is above one half by more than two posterior deviations.
HOST_RATE = 0.5
HOST_DEVIATIONS = 2.0
# Strength of the prior where the hosts do not tell (one host, or all alike), and its range.
DEFAULT_STRENGTH = 10.0
STRENGTHS = (1.0, 1e6)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line of the same text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def window_keys(words: Column) -> Column:
    """One digest per window of consecutive word digests; none for shorter texts."""
    starts = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(0), F.size(words) - WINDOW)).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))


def repeated_words(keys: Column) -> Column:
    """Words lying in a window that occurs more than once.

    Window starts are sorted by digest, those with an equal neighbour are put back into text order,
    and each adds the words up to the next one's start, a whole window at most.
    """
    ordered = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def here(x: Column, k: Column) -> Column:
            alike = (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            return F.when(F.coalesce(alike, F.lit(False)), x["i"])
        return F.sort_array(F.filter(F.transform(s, here), lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    some = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(some, let(let(ordered, starts), covered)).otherwise(0)


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the measures of each whole text (null: empty) as longs."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    digests = F.transform(words_column(value), lambda w: F.xxhash64(w))
    step = docs.select(
        *rest,
        F.length(without(value, WHITE)).alias("word_chars"),
        (F.length(value) - F.length(without(value, SYMBOLS))).alias("n_symbols"),
        duplicate_lines(value).alias("n_dup_lines"),
        once(digests).alias("__words"))
    step = step.select(*step.columns, once(window_keys(F.col("__words"))).alias("__keys"))
    return step.select(
        *rest, F.size("__words").cast("long").alias("n_words"),
        *[F.col(c).cast("long") for c in ("word_chars", "n_symbols", "n_dup_lines")],
        repeated_words(F.col("__keys")).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def beta_prior(hosts: DataFrame, n: str, bad: str) -> tuple[float, float]:
    """(mean, strength) of the beta prior by moments, hosts weighted by their documents."""
    s = hosts.agg(
        F.count("*").alias("h"), F.sum(F.col(n).cast("double")).alias("n"), F.sum(F.col(bad).cast("double")).alias("f"),
        F.sum(F.col(n).cast("double") ** 2).alias("n2"),
        F.sum(F.col(bad).cast("double") ** 2 / F.col(n)).alias("f2")).first()
    if not s.h:
        return 0.0, DEFAULT_STRENGTH
    mean = s.f / s.n
    spread = s.n - s.n2 / s.n - (s.h - 1)
    if s.h < 2 or mean in (0.0, 1.0) or spread <= 0:
        return mean, DEFAULT_STRENGTH
    between = (s.f2 - s.f * mean) / (mean * (1 - mean))
    rho = (between - (s.h - 1)) / spread
    strength = (1 - rho) / rho if rho > 0 else STRENGTHS[1]
    return mean, min(max(strength, STRENGTHS[0]), STRENGTHS[1])


def host_verdicts(measured: DataFrame, host: str = "host") -> DataFrame:
    """One row per host: its documents, failures, shrunk rate and whether it is rejected."""
    hosts = materialise(
        measured.where(F.col(host).isNotNull()).groupBy(host).agg(
            F.count("*").alias("host_docs"), F.count_if("base_failed").alias("host_failed")), "hosts")
    mean, strength = beta_prior(hosts, "host_docs", "host_failed")
    a, b = F.col("host_failed") + mean * strength, F.col("host_docs") - F.col("host_failed") + (1 - mean) * strength
    rate = a / (a + b)
    doubt = F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    return hosts.withColumn("host_rate", rate).withColumn(
        "host_rejected", rate - HOST_DEVIATIONS * doubt > HOST_RATE)


def judged(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` without its text, with measures, ``base_failed``, the host's counts and ``kept``.

    A null text is an empty one and fails.  A text without host stands alone: its host counts are
    null and it is kept unless it fails itself.  Repeated rows each count and each get a verdict.
    Columns of ``docs`` named like a result are replaced by it.  An empty table gives no rows.
    """
    added = {*MEASURES, "base_failed", "host_docs", "host_failed", "host_rate", "host_rejected", "kept", "__host"}
    rest = [c for c in docs.columns if c not in added and c != text]
    base = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{host}`").alias("__host"), F.col(f"`{text}`"))
    measured = materialise(text_measures(base, text).withColumn("base_failed", base_failed()), "measures")
    verdicts = materialise(host_verdicts(measured, "__host").withColumn("__rows", F.col("host_docs")), "verdicts")
    total = verdicts.agg(F.sum("__rows")).first()[0] or 0
    joined = attach(measured, verdicts, "__host", "__rows", total)
    gone = F.coalesce(F.col("host_rejected"), F.lit(False))
    return joined.withColumn("host_rejected", gone).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")).drop("__host")


def keep(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The rows of ``docs`` that neither fail by themselves nor come from a rejected host, unchanged.

    The texts are read twice: once to judge the hosts, once to pass them on.
    """
    measured = materialise(text_measures(docs.select(F.col(f"`{host}`").alias("__host"), F.col(f"`{text}`").alias("__text")),
                                         "__text").select("__host", base_failed().alias("base_failed")), "measures")
    verdicts = materialise(host_verdicts(measured, "__host").select(
        "__host", F.col("host_docs").alias("__rows"), F.col("host_rejected").alias("__rejected")), "verdicts")
    total = verdicts.agg(F.sum("__rows")).first()[0] or 0
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"),
                        F.col(f"`{host}`").alias("__host"), F.col(f"`{text}`").alias("__text"), row_hash(docs).alias("__mark"))
    passed = text_measures(named, "__text").where(~base_failed()).select("__doc", "__host", "__mark")
    left = attach(passed, verdicts, "__host", "__rows", total, F.col("__mark")).where(~F.coalesce(F.col("__rejected"), F.lit(False)))
    return left.select("__doc.*")
