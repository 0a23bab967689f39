"""The run summary: one row that nests the bridge and the backtest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BACKTEST_FIELDS = [
    "status", "holdout_months", "model_mape_pct", "seasonal_naive_mape_pct",
    "improvement_pct_points", "verdict",
]


def run_summary(
    fiscal_year: str, error: DataFrame, bridge: DataFrame, backtest: DataFrame
) -> DataFrame:
    """``error`` and ``backtest`` hold one row each, ``bridge`` five."""
    value = F.col("value").cast("double").alias("value")
    ordered = F.array_sort(F.collect_list(F.struct("step_no", "step", value, "kind")))
    steps = bridge.agg(
        F.transform(
            ordered,
            lambda s: F.struct(
                s["step"].alias("step"), s["value"].alias("value"), s["kind"].alias("kind")
            ),
        ).alias("bridge")
    )
    return steps.select(
        F.lit(fiscal_year).alias("fiscal_year"),
        error.select(F.col("reconciliation_error").cast("double")).scalar().alias(
            "reconciliation_error_inr"
        ),
        "bridge",
        backtest.select(F.struct(*BACKTEST_FIELDS)).scalar().alias("backtest"),
    )
