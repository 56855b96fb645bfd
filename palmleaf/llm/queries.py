"""The queries of the training-data operators: each applies its operator to a whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_pairs, decontam, ef_lm, gbdt_quality, line_dedup, mixing, secret_scan, trie_join, warc_fixity, zstd_bands
from .common import table


def op1_chat_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_pairs.format_pairs(chat_pairs.branched(table(spark, sf_dir, "conversations")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zstd_bands.compression_bands(table(spark, sf_dir, "documents"))


def op4_elias_fano_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ef_lm.score_texts(table(spark, sf_dir, "documents"))


def op5_trie_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.join_documents(table(spark, sf_dir, "documents"))


def op6_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc_fixity.audit_pages(pages, warc_fixity.replica_with_faults(pages))


def op7_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_words(table(spark, sf_dir, "documents"))


def op8_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gbdt_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_edit_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_pages(table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_chat_preference, op2_secret_scan, op3_compression_bands, op4_elias_fano_lm, op5_trie_jaccard, op6_merkle_fixity, op7_systematic_mix, op8_quality_trees, op9_edit_decontam, op10_site_lines)}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_preference": chat_pairs.SQL, "op6_merkle_fixity": warc_fixity.SQL, "op7_systematic_mix": mixing.SQL, "op10_site_lines": line_dedup.SQL}
