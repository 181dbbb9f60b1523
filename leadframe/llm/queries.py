"""Registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (cross_parse, decontam, divergence, html_render, imatch, license_rules, line_index, mixing,
               ngram_join, packing, pii, prefix_trie, url_filter)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_parse.predict(_read(spark, sf_dir, "documents"))


def op3_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(_read(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_render.extract(_read(spark, sf_dir, "pages"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_read(spark, sf_dir, "pages"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken")


def op8_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(_read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(_read(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_index.dedup(_read(spark, sf_dir, "documents")) \
        .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_read(spark, sf_dir, "conversations"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pack_tokens, op2_language, op3_benchmark_leaks, op4_imatch, op5_html_text, op6_url_filter,
        op7_mix_sources, op8_pii_spans, op9_ngram_jaccard, op10_licenses,
        op11_line_dedup, op12_prefix_trie, op13_source_divergence)}
ORACLES = {"op7_mix_sources": mixing.ORACLE, "op11_line_dedup": line_index.ORACLE,
           "op12_prefix_trie": prefix_trie.ORACLE, "op13_source_divergence": divergence.ORACLE}
