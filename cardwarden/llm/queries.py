"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import (
    balance, chats, classifier, host_rules, infill, leaks, licenses, lm, oracles, personal, pieces, secrets, simhash, trie)
from cardwarden.plans.catalog import table


def op1_entropy_balanced_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.mixed(table(spark, sf_dir, "documents"))


def op2_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return host_rules.judged(docs).select(
        "doc_id", *host_rules.MEASURES, "base_failed", "kept", "host_docs", "host_failed", "host_rejected")


def op3_backoff_automaton_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm.scored(table(spark, sf_dir, "documents"), held)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(table(spark, sf_dir, "documents"))


def op5_unigram_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.token_counts(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.scan(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_maximal_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.maximal(table(spark, sf_dir, "conversations"))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return classifier.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(table(spark, sf_dir, "conversations"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.transformed(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_entropy_balanced_mix, op2_host_quality_rules, op3_backoff_automaton_scores, op4_simhash_near_dedup,
    op5_unigram_token_counts, op6_secret_scan, op7_personal_data, op8_license_scan, op9_maximal_chats,
    op10_benchmark_leaks, op11_quality_classifier, op12_conversation_trie, op13_fill_in_middle)}
ORACLES = {"op2_host_quality_rules": oracles.HOST_RULES, "op9_maximal_chats": oracles.CHATS}
