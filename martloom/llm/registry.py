"""Registered queries of the text operators, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from martloom.llm import (
    chat_format,
    chunk_dedup,
    compression_quality,
    decontaminate,
    forest_join,
    html_blocks,
    merkle_audit,
    mixing,
    oracles,
    prefix_trie,
    string_kernel,
    token_planes,
    url_filter,
    vector_codes,
)
from martloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.groups(table(spark, sf_dir, "documents"))


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_planes.encode_and_read(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = forest_join.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "kept")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digests(chat_format.with_conflict(table(spark, sf_dir, "conversations")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_kernel.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle_audit.audit_pages(table(spark, sf_dir, "pages"))
    return found.withColumnsRenamed({"file": "file_no", "offset": "start"})


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.scored(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extracted(table(spark, sf_dir, "pages"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return oracles.statements()
