"""A training corpus in five stages: from documents to shuffled token files.

Each stage takes what the one before kept, as written and read again. All but the last give the
columns of ``documents``; the last gives the digests read back from the token files.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import partial

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from martloom.llm import (  # noqa: E402
    decontaminate,
    forest_join,
    mixing,
    string_kernel,
    token_planes,
)
from martloom.llm.common import table  # noqa: E402
from martloom.operators.scratch import distilled  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier accepts."""
    return string_kernel.accepted(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return forest_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for: not at all, once or twice."""
    return mixing.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document in the token files."""
    return token_planes.encode_and_read(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", without_near_copies),
    ("decontamination", without_benchmark),
    ("source_mix", mixed_sources),
    ("token_planes", token_files),
]

# The trained classifier, the mix and the tokenizer have no SQL; tests/llm/test_pipeline.py
# holds every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on its way goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = distilled(partial(stage, spark, docs, sf_dir), name)
    return docs
