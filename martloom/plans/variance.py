"""Price / volume / mix variance against the plan.

The gap to the plan has three parts. Price: the units sold, each at the difference of the two
average prices. Volume: the extra units of the whole business, spread as planned and at planned
prices. Mix: all units sold, by how far their split over the categories moved, at planned
prices. They add up to actual minus budget revenue. ``keys`` runs one decomposition
per store, region or any other column set, all in the same plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom import rules as r
from martloom.functions.rounding import MONEY, half_even, money, ratio
from martloom.operators.attach import attach
from martloom.operators.scratch import materialize
from martloom.plans.planning import in_fiscal_year
from martloom.rules import DEFAULT_RULES, Rules

VARIANCE_COLUMNS = [
    "category", "budget_qty", "actual_qty", "budget_price", "actual_price",
    "budget_revenue", "actual_revenue", "total_variance",
    "price_variance", "volume_variance", "mix_variance", "achievement_pct",
]

CRORE = 1e7


class VarianceRun(NamedTuple):
    by_category: DataFrame
    bridge: DataFrame


def actuals_by_category(
    detail: DataFrame, fiscal_year: str, keys: Sequence[str] = (), rules: Rules = DEFAULT_RULES
) -> DataFrame:
    return (
        in_fiscal_year(detail, fiscal_year, rules)
        .groupBy(*keys, "category")
        .agg(F.sum("quantity").alias("actual_qty"), F.sum("net_amount").alias("actual_revenue"))
    )


def budget_by_category(
    budget: DataFrame, fiscal_year: str, keys: Sequence[str] = ()
) -> DataFrame:
    return (
        budget.where(F.col("fiscal_year") == fiscal_year)
        .groupBy(*keys, "category")
        .agg(
            F.sum("budget_qty").alias("budget_qty"),
            F.sum("budget_revenue").alias("budget_revenue"),
        )
    )


def decompose(actual: DataFrame, budget: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per category, worst total variance first; all measures rounded to 2 digits.

    A category without a budget is all price variance and has no achievement; one without
    sales is all volume and mix. Both inputs are read twice: pass written tables when they
    are expensive.
    """
    keys = list(keys)
    measures = ["budget_qty", "budget_revenue", "actual_qty", "actual_revenue"]
    both = budget.join(actual, [*keys, "category"], "full").na.fill(0, measures)
    totals = both.groupBy(*keys).agg(
        F.sum("budget_qty").alias("_qb_all"), F.sum("actual_qty").alias("_qa_all")
    )
    qb, qa = F.col("budget_qty"), F.col("actual_qty")
    qb_all, qa_all = F.col("_qb_all"), F.col("_qa_all")
    pb, pa = F.col("_pb"), F.col("_pa")
    zero = F.lit(0.0)
    mb, ma = F.coalesce(ratio(qb, qb_all), zero), F.coalesce(ratio(qa, qa_all), zero)
    priced = attach(both, totals, keys).withColumns(
        {
            "_pb": F.coalesce(ratio(F.col("budget_revenue"), qb), zero),
            "_pa": F.coalesce(ratio(F.col("actual_revenue"), qa), zero),
        }
    )
    achieved = _achievement(F.col("actual_revenue"), F.col("budget_revenue"))
    return (
        priced.withColumns(
            {
                "budget_price": money(pb),
                "actual_price": money(pa),
                "budget_revenue": F.col("budget_revenue").cast(MONEY),
                "actual_revenue": F.col("actual_revenue").cast(MONEY),
                "total_variance": (F.col("actual_revenue") - F.col("budget_revenue")).cast(MONEY),
                "price_variance": money(qa * (pa - pb)),
                "volume_variance": money(pb * mb * (qa_all - qb_all)),
                "mix_variance": money(pb * qa_all * (ma - mb)),
                "achievement_pct": achieved,
            }
        )
        .select(*keys, *VARIANCE_COLUMNS)
        .orderBy(*keys, "total_variance", "category")
    )


def _achievement(top: Column, bottom: Column, digits: int = 1) -> Column:
    return half_even(ratio(top, bottom) * 100.0, digits)


def bridge(decomposed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Budget, price, volume, mix, actual: five rows per key, from the rounded rows."""
    sums = decomposed.groupBy(*keys).agg(
        F.sum("budget_revenue").alias("b"),
        F.sum("price_variance").alias("p"),
        F.sum("volume_variance").alias("v"),
        F.sum("mix_variance").alias("m"),
    )
    ends = F.col("b") + F.col("p") + F.col("v") + F.col("m")
    rows = [
        (1, r.STEP_BUDGET, F.col("b"), "total"),
        (2, r.STEP_PRICE, F.col("p"), "delta"),
        (3, r.STEP_VOLUME, F.col("v"), "delta"),
        (4, r.STEP_MIX, F.col("m"), "delta"),
        (5, r.STEP_ACTUAL, ends, "total"),
    ]
    steps = F.array(
        *[
            F.struct(
                F.lit(no).alias("step_no"),
                F.lit(step).alias("step"),
                value.cast("decimal(38,2)").alias("value"),
                F.lit(kind).alias("kind"),
            )
            for no, step, value, kind in rows
        ]
    )
    return sums.select(*keys, F.inline(steps))


def reconciliation_error(decomposed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """How far the three effects, as rounded, are from the total variance."""
    parts = F.col("price_variance") + F.col("volume_variance") + F.col("mix_variance")
    gap = F.abs(F.sum(parts) - F.sum("total_variance"))
    return decomposed.groupBy(*keys).agg(gap.alias("reconciliation_error"))


def largest_miss(decomposed: DataFrame) -> DataFrame:
    return decomposed.orderBy("total_variance", "category").limit(1)


def waterfall(bridge_rows: DataFrame, keys: Sequence[str] = (), unit: float = CRORE) -> DataFrame:
    """Bars of the waterfall chart: totals stand on zero, deltas on the running level."""
    order = Window.partitionBy(*keys).orderBy("step_no")
    is_total = F.col("kind") == "total"
    since_total = Window.partitionBy(*keys, "_block").orderBy("step_no")
    level = F.sum("value").over(since_total.rowsBetween(Window.unboundedPreceding, -1))
    value = F.col("value").cast("double")
    return (
        bridge_rows.withColumn("_block", F.sum(is_total.cast("int")).over(order))
        .withColumn("_level", F.when(is_total, 0).otherwise(level))
        .select(
            *keys,
            "step_no",
            "step",
            (F.col("_level").cast("double") / unit).alias("bottom"),
            (value / unit).alias("height"),
            F.when(is_total, "total").when(value >= 0, "up").otherwise("down").alias("direction"),
        )
    )


def run(
    detail: DataFrame,
    budget: DataFrame,
    fiscal_year: str,
    keys: Sequence[str] = (),
    rules: Rules = DEFAULT_RULES,
) -> VarianceRun:
    """Aggregate once, keep the small per-category sums, then decompose and bridge."""
    actual = materialize(actuals_by_category(detail, fiscal_year, keys, rules), "actuals")
    planned = materialize(budget_by_category(budget, fiscal_year, keys), "budget")
    by_category = decompose(actual, planned, keys)
    return VarianceRun(by_category, bridge(by_category, keys))
