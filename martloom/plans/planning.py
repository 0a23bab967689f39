"""Plan builder: last fiscal year's actuals, uprated by a flat percentage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions.rounding import half_even, ratio
from martloom.rules import DEFAULT_RULES, PLAN_UPLIFT, Rules


def in_fiscal_year(detail: DataFrame, label: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Lines of one fiscal year, as a date range that scans can skip data by."""
    first, after = cal.fiscal_bounds(label, rules)
    day = F.col("date_key")
    return detail.where((day >= F.lit(first)) & (day < F.lit(after)))


def build_plan(
    detail: DataFrame,
    prior_year: str,
    uplift: float = PLAN_UPLIFT,
    keys: Sequence[str] = (),
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Budget rows per (month, category) for the year after ``prior_year``.

    Units grow by ``uplift``; price stays at last year's average; the mix stays as it was.
    """
    units, revenue = F.sum("quantity"), F.sum("net_amount")
    return (
        in_fiscal_year(detail, prior_year, rules)
        .groupBy(*keys, F.month("date_key").alias("month"), "category")
        .agg(
            half_even(units * F.lit(uplift), 0).cast("bigint").alias("budget_qty"),
            half_even(ratio(revenue, units), 2).alias("price"),
        )
        .select(
            *keys,
            F.lit(cal.next_fiscal_label(prior_year)).alias("fiscal_year"),
            "month",
            "category",
            "budget_qty",
            F.col("price").cast("decimal(18,2)").alias("budget_price"),
            half_even(F.col("budget_qty") * F.col("price"), 2)
            .cast("decimal(18,2)")
            .alias("budget_revenue"),
        )
    )
