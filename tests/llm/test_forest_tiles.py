"""Joins see a member of a hot node once, however many tiles the node is dealt to."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martloom.llm import forest_join as fj

ROWS = 50


@pytest.fixture
def members(spark, tmp_path, monkeypatch):
    """One hot node of ``ROWS`` texts in five blocks."""
    monkeypatch.setattr(fj, "BLOCK_DOCS", 10)
    tries = spark.range(ROWS).select(
        F.lit(0).alias("tree"), F.lit(7).cast("bigint").alias("label"),
        F.col("id").cast("string").cast("binary").alias("rep"), F.lit(3).alias("n"),
    )
    tries.write.parquet(str(tmp_path / "tries"))
    return fj._tiles(spark.read.parquet(str(tmp_path / "tries")), fj.DEPTH)


def test_a_member_of_a_hot_node_is_one_row_until_it_is_dealt(members):
    assert members.count() == ROWS
    dealt = fj._in_tiles(members)
    assert dealt.count() == 5 * ROWS
    met = dealt.alias("x").join(dealt.alias("y"), ["tree", "key", "low", "high"])
    met = met.where("(x.block = low AND y.block = high)").select("x.rep", F.col("y.rep").alias("other"))
    either = met.union(met.select("other", "rep")).distinct()
    assert either.count() == ROWS * ROWS  # every pair meets in some tile


def test_payloads_are_joined_before_members_are_dealt(members):
    dealt = fj._in_tiles(members)
    payload = members.select("rep", F.lit("x").alias("carried")).hint("merge")
    moved = fj._with_payload(dealt, payload)
    assert sorted(moved.columns) == sorted([*dealt.columns, "carried"])
    assert moved.select(dealt.columns).exceptAll(dealt).count() == 0 and moved.count() == dealt.count()
    plan = moved._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {word: next(i for i, line in enumerate(plan) if word in line) for word in ("Generate", "Join")}
    assert depth["Generate"] < depth["Join"]  # dealt above the join
