"""The corpus pipeline: documents in, a decontaminated and balanced mix out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwarden.llm import balance, host_rules, leaks, near, secrets
from cardwarden.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the rules nor come from a rejected host."""
    return host_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts whose five-word shingles are alike by 0.8, the one with the smallest id."""
    return near.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in the text and ``n_chars`` counted anew."""
    return secrets.redact(docs, length="n_chars")


def balanced_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents taken at least once, with their number of copies and what they weigh in the mix."""
    return balance.mixed(docs, carry=True).where("copies > 0")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secret masking", mask_secrets),
    ("balanced mix", balanced_mix),
]

# SimHash components, random walks and tokenizers are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
