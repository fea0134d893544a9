"""One query for each numbered operator, and the pipeline.  Every query reads
its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (binary_ids, cover_codes, crf_langid, filter_audit, isolation, line_chunks, pieces, positional_index,
               pu_quality, randomness, simhash_trie, suffix_dedup, token_counts)
from .common import read_table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op1_suffix_dedup(read_table(spark, sf_dir, "documents"))


def op2_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.op2_positional_index(read_table(spark, sf_dir, "documents"),
                                                 read_table(spark, sf_dir, "benchmark"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.op3_line_chunks(read_table(spark, sf_dir, "documents"))


def op4_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return randomness.op4_randomness(read_table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op5_sentencepiece(read_table(spark, sf_dir, "documents"))


def op6_binary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binary_ids.op6_binary_ids(read_table(spark, sf_dir, "documents"))


def op7_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.op7_simhash_trie(read_table(spark, sf_dir, "documents"))


def op8_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = isolation.op8_isolation_forest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.drop("anomaly")


def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.op9_pu_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_langid.op10_language_crf(read_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.op11_filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_cover_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_codes.op12_cover_codes(read_table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.op13_token_counts(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_positional_index": op2_positional_index,
    "op3_line_chunks": op3_line_chunks,
    "op4_randomness": op4_randomness,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_binary_ids": op6_binary_ids,
    "op7_simhash_trie": op7_simhash_trie,
    "op8_isolation_forest": op8_isolation_forest,
    "op9_pu_quality": op9_pu_quality,
    "op10_language_crf": op10_language_crf,
    "op11_filter_audit": op11_filter_audit,
    "op12_cover_codes": op12_cover_codes,
    "op13_token_counts": op13_token_counts,
}
