"""Ranks, medians, calendar, rounding and dimensions against plain Python."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions.rounding import half_even, half_up, ratio
from martloom.operators import dimensions as dims
from martloom.operators.median import exact_median, histogram
from martloom.operators.ranking import ntile_of, quantile_score, with_global_ranks

# --- ranks --------------------------------------------------------------------------


def test_global_ranks_with_a_hot_value(spark):
    rng = random.Random(5)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(50)) for i in range(5003)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id int, measure int").repartition(7)
    orders = {
        "down": [F.desc("measure"), F.asc("id")],
        "up": [F.asc("measure"), F.asc("id")],
    }
    ranked = with_global_ranks(df, orders, "n")
    assert dict(ranked.dtypes)["down"] == "bigint"
    ranked = ranked.collect()
    for name, sign in (("down", -1), ("up", 1)):
        order = sorted(rows, key=lambda row: (sign * row[1], row[0]))
        assert {row.id: row[name] for row in ranked} == {
            row[0]: place for place, row in enumerate(order, start=1)
        }
    assert {row.n for row in ranked} == {len(rows)}


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_ranks_never_sort_in_one_task(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 5).alias("measure"))
    ranked = with_global_ranks(df, {"place": [F.asc("measure"), F.asc("id")]})
    assert sorted(row.place for row in ranked.collect()) == list(range(1, rows + 1))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Sort [measure" not in plan


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 9, 10, 11, 37, 99, 100, 101, 723, 1204])
def test_scores_match_quantile_cut(spark, n):
    ranks = spark.range(1, n + 1).select(F.col("id"), F.lit(n).cast("bigint").alias("n"))
    got = [
        tuple(row)
        for row in ranks.select(
            quantile_score(F.col("id"), F.col("n")), ntile_of(F.col("id"), F.col("n"), 10)
        ).collect()
    ]
    if n == 1:
        assert got == [(1, 1)]
        return
    cut = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=range(1, 6)).astype(int)
    sizes = [n // 10 + (tile < n % 10) for tile in range(10)]
    tiles = [tile for tile, size in enumerate(sizes, start=1) for _ in range(size)]
    assert got == list(zip(cut, tiles, strict=True))


# --- medians ------------------------------------------------------------------------


@settings(max_examples=12, deadline=None)
@given(
    st.dictionaries(
        st.sampled_from("abc"),
        st.lists(st.integers(0, 5000).map(lambda v: v / 100), min_size=1, max_size=40),
        min_size=1,
    )
)
def test_exact_median_per_key(spark, groups):
    rows = [(key, value) for key, values in groups.items() for value in values]
    df = spark.createDataFrame(rows, "k string, v double")
    got = exact_median(histogram(df, "v", ["k"]), "v", ["k"]).collect()
    assert {row.k: row.median for row in got} == {
        key: pytest.approx(statistics.median(values)) for key, values in groups.items()
    }


def test_median_of_a_hot_key_over_many_partitions(spark):
    rng = random.Random(8)
    rows = [("hot", rng.random()) for _ in range(9000)] + [("cold", 3.0), ("cold", 4.0)]
    counts = histogram(spark.createDataFrame(rows, "k string, v double"), "v", ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r.k: r.median for r in exact_median(counts, "v", ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = statistics.median(v for k, v in rows if k == "hot")
    assert found == {"hot": pytest.approx(want), "cold": 3.5}


def test_exact_median_without_keys_skips_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (3.0,), (2.0,)], "v double")
    assert exact_median(histogram(df, "v"), "v").first().median == 2.5
    empty = df.where("v > 9")
    assert exact_median(histogram(empty, "v"), "v").first().median is None


# --- calendar -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def days(spark):
    span = spark.sql("SELECT date'2024-02-27' AS first, date'2026-04-02' AS last")
    return {row.date_key: row for row in dims.date_table(span).collect()}


def test_fiscal_year_turns_on_the_first_of_april(days):
    assert days[dt.date(2025, 3, 31)].fiscal_year == "FY2024-25"
    assert days[dt.date(2025, 4, 1)].fiscal_year == "FY2025-26"
    assert days[dt.date(2025, 3, 31)].fiscal_month == 12
    assert days[dt.date(2025, 4, 1)].fiscal_month == 1
    assert days[dt.date(2025, 1, 15)].fiscal_month == 10


def test_every_day_and_its_parts(days):
    expected = pd.date_range("2024-02-27", "2026-04-02")
    assert sorted(days) == [d.date() for d in expected]
    for d in expected:
        row = days[d.date()]
        assert (row.year, row.month, row.quarter) == (d.year, d.month, d.quarter)
        assert row.day_of_week == d.weekday()
        assert row.is_weekend == int(d.weekday() >= 5)
        assert row.month_name == d.strftime("%B")


def test_fiscal_label_at_the_turn_of_a_century(spark):
    row = spark.sql("SELECT date'1999-12-31' AS d").select(cal.fiscal_year(F.col("d"))).first()
    assert row[0] == "FY1999-00"
    assert cal.next_fiscal_label("FY1998-99") == "FY1999-00"
    assert cal.fiscal_bounds("FY1999-00") == (dt.date(1999, 4, 1), dt.date(2000, 4, 1))


def test_other_fiscal_start(spark):
    row = spark.sql("SELECT date'2025-06-30' AS a, date'2025-07-01' AS b").select(
        cal.fiscal_year(F.col("a"), 7), cal.fiscal_year(F.col("b"), 7), cal.fiscal_month(F.col("b"), 7)
    ).first()
    assert tuple(row) == ("FY2024-25", "FY2025-26", 1)


# --- rounding -----------------------------------------------------------------------


def test_rounding_follows_the_scaled_value(spark):
    values = [0.125, 1.005, 2.675, -0.125, -1.5, 0.375, 1234.565, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    even = [row[0] for row in df.select(half_even(F.col("v"))).collect()]
    assert even == list(np.round(values, 2))
    up = [row[0] for row in df.select(half_up(F.col("v"))).collect()]
    assert up[0] == 0.13 and up[3] == -0.13


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


# --- dimensions ---------------------------------------------------------------------


def test_price_band_uses_the_true_median(spark):
    # The middle of 1..4 is 2.5; the lower middle value would be 2.
    rows = [("a", "x", price) for price in (1000, 1400, 1600, 2000)]
    tx = spark.createDataFrame(rows, "category string, channel string, unit_price int")
    (row,) = dims.dim_category(tx).collect()
    assert (row.category_id, row.price_band) == (1, "Mid")
    (row,) = dims.dim_category(tx, approx=True).collect()
    assert row.price_band == "Value"


def test_channel_keys_follow_sorted_names(spark):
    names = ["Online", "Walk-in", "Exhibition Stall", "WhatsApp Order", "Online"]
    tx = spark.createDataFrame([(n,) for n in names], "channel string")
    rows = dims.dim_channel(tx).orderBy("channel_id").collect()
    assert [tuple(row) for row in rows] == [
        (1, "Exhibition Stall", 1),
        (2, "Online", 0),
        (3, "Walk-in", 1),
        (4, "WhatsApp Order", 0),
    ]


def test_a_missing_name_gets_no_key(spark):
    rows = [("a", "x", 1.0), (None, None, 2.0), ("b", None, 3.0)]
    tx = spark.createDataFrame(rows, "category string, channel string, unit_price double")
    assert [tuple(r) for r in dims.dim_channel(tx).collect()] == [(1, "x", 0)]
    found = dims.dim_category(tx).orderBy("category_id").collect()
    assert [(r.category_id, r.category) for r in found] == [(1, "a"), (2, "b")]
