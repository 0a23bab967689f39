"""Result files. Each is a folder of part files, as Spark writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martloom.operators.bills import repeated_hashes
from martloom.plans import views
from martloom.rules import DEFAULT_RULES, Rules

EXTRACTS = ["v_monthly_kpi", "v_channel_mix", "v_customer_concentration", "fact_monthly_grain"]


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> str:
    """``one_file`` is for reports whose rows are months, channels, deciles or segments; any
    other result stays in as many files as it has partitions."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def export_extracts(
    detail: DataFrame, out_dir: str, rules: Rules = DEFAULT_RULES, unique_ids: bool = False
) -> list[str]:
    """The three aggregate views and the monthly grain, for BI tools to import as they are.
    Both that count bills share one look for repeated ids."""
    repeated = None if unique_ids else repeated_hashes(detail)
    frames = [
        views.monthly_kpi(detail, rules, unique_ids, repeated).orderBy("year", "month"),
        views.channel_mix(detail, rules).orderBy("fiscal_year", "channel"),
        views.customer_concentration(detail),
        views.monthly_grain(detail, rules=rules, unique_ids=unique_ids, repeated=repeated),
    ]
    small = [True, True, True, False]
    return [
        write_csv(frame, f"{out_dir}/{name}", one_file=few)
        for name, frame, few in zip(EXTRACTS, frames, small, strict=True)
    ]
