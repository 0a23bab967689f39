"""Command line of the product: load extracts, check them, write every result.

Loads when asked to with ``--rebuild`` or when ``--out`` holds no warehouse yet. A load whose
contracts are violated ends with an error after its report is written, and readers keep the
warehouse they had, unless ``--allow-violations`` is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from martloom.operators import contracts
from martloom.operators.scratch import materialize, scope
from martloom.plans import customers, forecasting, summary, variance, views, warehouse
from martloom.sinks.exports import export_extracts, write_csv, write_json
from martloom.sources import extracts


def run_all(
    stored: warehouse.Warehouse, out_dir: str, fiscal_year: str, horizon: int = 6
) -> None:
    """Every analysis of a stored warehouse, written below ``out_dir``. Variance and forecast
    share one written table of monthly sums; only counts of customers and bills need lines."""
    detail = views.sales_detail(stored)
    cells = materialize(views.monthly_cells(detail), "cells")

    gap = variance.run(cells, stored.budget, fiscal_year)
    write_csv(gap.by_category, f"{out_dir}/variance_by_category", one_file=True)
    write_csv(gap.bridge, f"{out_dir}/variance_bridge", one_file=True)

    buyers = customers.run(detail, unique_ids=stored.unique_ids)
    write_csv(buyers.customers, f"{out_dir}/rfm_customers")
    write_csv(buyers.segments, f"{out_dir}/rfm_segments", one_file=True)

    outlook = forecasting.run(cells, horizon)
    write_csv(outlook.forecast.orderBy("period"), f"{out_dir}/forecast", one_file=True)

    export_extracts(detail, f"{out_dir}/powerbi", unique_ids=stored.unique_ids)
    write_json(
        summary.run_summary(
            fiscal_year,
            variance.reconciliation_error(gap.by_category),
            gap.bridge,
            outlook.backtest,
        ),
        f"{out_dir}/summary",
    )


def refresh(
    spark: SparkSession, data_dir: str, store: str, out_dir: str, fmt: str = "parquet"
) -> tuple[warehouse.Warehouse, list[str]]:
    """Load the extracts as a new version that is not current yet, write the contract report
    and name what it found, in the stored tables or in the extract's own lines."""
    built = warehouse.build_from_csv(spark, data_dir)
    stored = warehouse.save(built, store, fmt, make_current=False)
    report = contracts.contract_report(
        stored.tables(), extract_rows=stored.extract_rows, observed=stored.observed
    )
    lines = contracts.extract_checks(
        extracts.read_transactions(spark, f"{data_dir}/transactions.csv")
    )
    path = write_csv(report.unionByName(lines), f"{out_dir}/contracts", one_file=True)
    found = spark.read.option("header", True).csv(path).where("violations > 0").orderBy("check")
    return stored, [f"{row.check}: {row.violations}" for row in found.collect()]


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martloom", description=__doc__)
    parser.add_argument("--data", required=True, help="folder of the CSV extracts")
    parser.add_argument("--out", required=True)
    parser.add_argument("--rebuild", action="store_true", help="load the extracts again")
    parser.add_argument("--allow-violations", action="store_true", help="report them and go on")
    parser.add_argument("--fiscal-year", default="FY2025-26")
    parser.add_argument("--horizon", type=int, default=6)
    parser.add_argument("--format", default="parquet", choices=["parquet", "delta"])
    asked = parser.parse_args(args)

    spark = SparkSession.builder.appName("martloom").getOrCreate()
    store = f"{asked.out}/warehouse"
    with scope():
        stored = None if asked.rebuild else warehouse.load(spark, store, asked.format)
        if stored is None:
            stored, violations = refresh(spark, asked.data, store, asked.out, asked.format)
            if violations and not asked.allow_violations:
                sys.exit("contracts violated:\n" + "\n".join(violations))
            warehouse.publish(stored, store)
        run_all(stored, asked.out, asked.fiscal_year, asked.horizon)


if __name__ == "__main__":
    main()
