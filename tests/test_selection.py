"""Boundary rows, tiles and scores found by selection, against sorted lists."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators import selection
from martloom.operators.scratch import materialize
from martloom.operators.selection import rows_at, score_ends, tile_ends
from martloom.plans import customers


def _null_first(value):
    return (value is not None, value)


def _sorted_keys(rows):
    return sorted(rows, key=lambda row: tuple(_null_first(value) for value in row))


@pytest.fixture(scope="module")
def measured(spark):
    """A third of the rows share one value, some have none, and ids are text."""
    rng = random.Random(4)
    rows = []
    for i in range(6000):
        amount = Decimal("7.50") if i % 3 == 0 else Decimal(rng.randrange(10**6)) / 100
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(40))
        rows.append((f"c{i:05d}" if i else None, None if i % 11 == 1 else amount, day))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, amount decimal(18,2), day date")
    return rows, materialize(df.repartition(5), "measured")


@pytest.mark.parametrize(("leaf", "sample"), [(1 << 14, 1 << 14), (300, 400), (40, 60)])
def test_rows_at_any_rank(measured, leaf, sample):
    rows, table = measured
    ranks = [1, 2, 1999, 2000, 2001, 3000, 5999, 6000]
    orders = {
        "amount": [F.col("amount"), F.col("id")],
        "down": [F.col("amount").isNull(), -F.col("amount"), F.col("id")],
        "day": [F.col("day"), F.col("id")],
    }
    found = rows_at(table, orders, lambda n: ranks, leaf, sample)
    keys = {
        "amount": _sorted_keys((amount, key) for key, amount, _ in rows),
        "down": _sorted_keys(
            (amount is None, None if amount is None else -amount, key) for key, amount, _ in rows
        ),
        "day": _sorted_keys((day, key) for key, _, day in rows),
    }
    assert found == {name: [keys[name][rank - 1] for rank in ranks] for name in orders}


def test_rows_that_are_all_alike(spark):
    table = materialize(spark.range(5000).select(F.lit(3).alias("v")), "alike")
    found = rows_at(table, {"v": [F.col("v")]}, lambda n: [1, 2500, n], leaf=40, sample=50)
    assert found == {"v": [(3,), (3,), (3,)]}


def test_an_empty_table_has_no_boundaries(spark):
    table = spark.range(0)
    assert rows_at(table, {"id": [F.col("id")]}, lambda n: [1]) == {"id": []}
    assert selection.with_tiles(table, {"t": [F.col("id")]}, 10).collect() == []


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=40))
def test_tiles_and_scores_of_small_tables(spark, values):
    rows = list(enumerate(values))
    table = spark.createDataFrame(rows, "id int, v int")
    order = {"step": [F.col("v"), F.col("id")]}
    tiles = {r.id: r.step for r in selection.with_tiles(table, order, 4).collect()}
    scores = {r.id: r.step for r in selection.with_quantile_scores(table, order, 5).collect()}
    places = {key: i for i, (_, key) in enumerate(_sorted_keys((v, i) for i, v in rows))}
    n = len(rows)
    dealt = [t for t in range(1, 5) for _ in range(n // 4 + (t <= n % 4))]
    assert tiles == {key: dealt[place] for key, place in places.items()}
    if n > 1:
        cut = pd.qcut(np.arange(n), 5, labels=False) + 1
        assert scores == {key: cut[place] for key, place in places.items()}


@pytest.mark.parametrize("n", [1, 2, 5, 9, 10, 11, 99, 100, 101, 1204])
def test_last_ranks(n):
    ends = [0, *tile_ends(n, 10), n]
    assert [b - a for a, b in zip(ends, ends[1:])] == [n // 10 + (t < n % 10) for t in range(10)]
    if n > 1:
        cut = pd.qcut(np.arange(n), 5, labels=False)
        assert score_ends(n, 5) == [int((cut <= score).sum()) for score in range(4)]


def test_a_leaf_that_no_search_reaches_is_refused(spark):
    with pytest.raises(ValueError, match="leaf"):
        rows_at(spark.range(9), {"id": [F.col("id")]}, lambda n: [1], leaf=1)


def test_steps_neither_sort_nor_shuffle_nor_write_rows(measured):
    _, table = measured
    history = table.select(
        F.col("id").alias("customer_id"), F.col("day").alias("last_purchase"),
        F.length("id").alias("frequency"), F.col("amount").alias("monetary"),
    )
    for scored in (
        customers.with_scores(history),
        selection.with_tiles(table, {"t": [F.col("amount"), F.col("id")]}, 10),
    ):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan
        assert plan.count("FileScan") == 1 and "measured" in plan


@pytest.mark.parametrize(
    "values",
    [[], [2.0], [1.0, 2.5], [None, 4.0, None, 1.0, 3.0], [None] * 3],
    ids=["none", "one", "two", "with nulls", "only nulls"],
)
def test_median_of_few(spark, values):
    table = spark.createDataFrame([(v,) for v in values], "v double")
    known = [v for v in values if v is not None]
    assert selection.median(table, F.col("v")) == (statistics.median(known) if known else None)


def test_median_whose_first_sample_misses(spark, monkeypatch):
    """Proposals far from the middle only cost another round."""
    values = [float(i * i) for i in range(4001)] + [9.0] * 1500
    table = materialize(spark.createDataFrame([(v,) for v in values], "v double"), "missed")
    propose, rounds = selection._propose, []

    def misled(*args):
        rounds.append(args)
        if len(rounds) == 1:
            return {target: ((-5.0,), (9.0,)) for target in args[2]}
        return propose(*args)

    monkeypatch.setattr(selection, "_propose", misled)
    assert selection.median(table, F.col("v"), leaf=500, sample=900) == statistics.median(values)
    assert len(rounds) > 2
