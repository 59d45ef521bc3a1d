"""The queries of this subpackage: (spark, folder of the tables) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremora.llm import (
    alignment, bpe, decontaminate, exact_dedup, language, packing, prefix_trie, quality, secrets_forest, simhash, suffix_dedup,
    token_files, toxicity,
)
from tremora.llm.common import scratch_path, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.read_digests(spark, path)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.length_buckets(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_forest.scan_secrets(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_language_id, op3_token_files, op4_toxicity, op5_decontaminate, op6_length_buckets, op7_exact_dedup,
        op8_quality, op9_simhash, op10_secrets, op11_prefix_trie, op12_bpe, op13_alignment)
}
ORACLES: dict[str, str] = {
    "op5_decontaminate": decontaminate.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE, "op11_prefix_trie": prefix_trie.ORACLE}
