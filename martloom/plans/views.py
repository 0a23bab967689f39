"""Reporting views over the star schema.

The aggregate views take any frame with the columns they read: the star join of a stored
warehouse (:func:`sales_detail`) or the transactions themselves (:func:`flat_sales`),
which saves the surrogate-key round trip when nothing is stored. They group on one date
per month and put names on the few result rows, so no label is shuffled with the lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions.rounding import half_up, percent, ratio
from martloom.operators.bills import with_bills
from martloom.operators.facts import gross_margin
from martloom.operators.scratch import materialize
from martloom.operators.selection import with_tiles
from martloom.plans.warehouse import Warehouse
from martloom.rules import DEFAULT_RULES, Rules
from martloom.schemas import SALES_DETAIL_COLUMNS


def sales_detail(warehouse: Warehouse) -> DataFrame:
    """The fact with all its dimensions. Rows without a match in a dimension drop out."""
    fact = warehouse.fact_sales
    # A stored fact is partitioned by year_month; joining on it as well lets a filter on
    # dim_date skip folders.
    stored = "year_month" in fact.columns and "year_month" in warehouse.dim_date.columns
    date_keys = ["date_key", "year_month"] if stored else ["date_key"]
    return (
        fact.join(warehouse.dim_date, date_keys)
        .join(warehouse.dim_store, "store_id")
        .join(warehouse.dim_category, "category_id")
        .join(warehouse.dim_channel, "channel_id")
        .select(*SALES_DETAIL_COLUMNS)
    )


def flat_sales(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """The measures and names of the detail view straight from the transactions.

    Calendar, category, channel and customer tables are derived from the transactions, so
    every line has its match in them by construction. Stores are given: lines of unknown
    stores drop out, as they do in the star join.
    """
    key = [c for c in ("transaction_key",) if c in transactions.columns]
    return transactions.join(
        stores.select("store_id", "store_name"), "store_id"
    ).select(
        *key,
        "transaction_id",
        F.col("transaction_date").alias("date_key"),
        "store_id",
        "store_name",
        "category",
        "channel",
        "customer_id",
        "quantity",
        "unit_price",
        "discount_pct",
        "net_amount",
        "cogs",
        gross_margin(),
    )


def monthly_cells(detail: DataFrame) -> DataFrame:
    """Lines summed by month, store, category and channel, under the lines' own column names and
    dated on the first of the month. Whatever works by month or fiscal year on sums of lines,
    as variance and forecast do, gives the same on these few rows."""
    first = cal.month_start(F.col("date_key")).alias("date_key")
    return detail.groupBy(first, "store_name", "category", "channel").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("net_amount").alias("net_amount"),
        F.sum("gross_margin").alias("gross_margin"),
    )


def _period() -> Column:
    return cal.month_start(F.col("date_key")).alias("period")


def _month_labels(rules: Rules) -> list[Column]:
    period = F.col("period")
    return [
        cal.fiscal_year(period, rules.fiscal_start_month).alias("fiscal_year"),
        F.year(period).alias("year"),
        F.month(period).alias("month"),
        cal.month_name(period).alias("month_name"),
        cal.season(period, rules.seasons).alias("season"),
    ]


def _avg_discount_pct() -> Column:
    """Unweighted line mean; the DECIMAL sum makes it independent of row order."""
    mean = ratio(F.sum("discount_pct"), F.count("discount_pct"))
    return half_up(mean * 100.0)


def monthly_kpi(
    detail: DataFrame,
    rules: Rules = DEFAULT_RULES,
    unique_ids: bool = False,
    repeated: DataFrame | None = None,
) -> DataFrame:
    revenue, margin = F.sum("net_amount"), F.sum("gross_margin")
    sums = [
        F.count_distinct("customer_id").alias("customers"),
        F.sum("quantity").alias("units"),
        revenue.alias("revenue"),
        margin.alias("gross_margin"),
        half_up(percent(margin, revenue)).alias("gm_pct"),
        _avg_discount_pct().alias("avg_discount_pct"),
    ]
    months = with_bills(detail, [_period()], sums, unique_ids, repeated)
    bill_value = half_up(ratio(F.col("revenue"), F.col("bills"))).alias("avg_bill_value")
    return months.select(
        *_month_labels(rules), "bills", "customers", "units", "revenue",
        "gross_margin", "gm_pct", bill_value, "avg_discount_pct",
    )


def channel_mix(detail: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    revenue, margin = F.sum("net_amount"), F.sum("gross_margin")
    start = cal.fiscal_start_year(F.col("date_key"), rules.fiscal_start_month)
    year_total = F.sum("revenue").over(Window.partitionBy("start_year"))
    return (
        detail.groupBy(start.alias("start_year"), "channel")
        .agg(
            revenue.alias("revenue"),
            half_up(percent(margin, revenue)).alias("gm_pct"),
            _avg_discount_pct().alias("avg_discount_pct"),
            F.count_distinct("customer_id").alias("customers"),
        )
        .withColumn("pct_of_revenue", half_up(percent(F.col("revenue"), year_total)))
        .select(
            cal.fiscal_label(F.col("start_year")).alias("fiscal_year"),
            "channel", "revenue", "pct_of_revenue", "gm_pct", "avg_discount_pct", "customers",
        )
    )


def customer_concentration(detail: DataFrame, tiles: int = 10) -> DataFrame:
    """Revenue by customer decile, best customers first; equal customers order by id."""
    customers = detail.groupBy("customer_id").agg(F.sum("net_amount").alias("ltv"))
    ltv = F.col("ltv")
    best_first = [ltv.isNull(), -ltv, F.col("customer_id")]
    dealt = with_tiles(materialize(customers, "ltv"), {"decile": best_first}, tiles)
    all_deciles = Window.partitionBy()  # at most ``tiles`` rows
    return (
        dealt.groupBy("decile")
        .agg(F.count("*").alias("customers"), F.sum("ltv").alias("revenue"))
        .withColumn(
            "pct_of_revenue",
            half_up(percent(F.col("revenue"), F.sum("revenue").over(all_deciles))),
        )
        .orderBy("decile")
    )


def cumulative_concentration(concentration: DataFrame) -> DataFrame:
    """Revenue and share of the best decile, the best two, and so on."""
    upto = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("revenue").over(upto)
    total = F.sum("revenue").over(Window.partitionBy())
    return concentration.select(
        "decile",
        F.sum("customers").over(upto).alias("cum_customers"),
        running.alias("cum_revenue"),
        half_up(percent(running, total)).alias("cum_pct_of_revenue"),
    )


def monthly_grain(
    detail: DataFrame,
    categories: DataFrame | None = None,
    rules: Rules = DEFAULT_RULES,
    unique_ids: bool = False,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """The pre-aggregated extract. ``categories`` supplies price bands if ``detail`` has none;
    it then joins the aggregated rows, not the lines."""
    keys = ["store_name", "category", "channel"]
    if categories is None:
        keys.append("price_band")
    sums = [
        F.sum("quantity").alias("units"),
        F.sum("net_amount").alias("revenue"),
        F.sum("gross_margin").alias("gross_margin"),
    ]
    grain = with_bills(detail, [_period(), *keys], sums, unique_ids, repeated)
    if categories is not None:
        grain = grain.join(categories.select("category", "price_band"), "category")
    return grain.select(
        *_month_labels(rules), "store_name", "category", "price_band", "channel",
        "bills", "units", "revenue", "gross_margin",
    )


def season_rollup(detail: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Revenue by retail season over the monthly totals."""
    months = detail.groupBy(_period()).agg(F.sum("net_amount").alias("revenue"))
    return months.groupBy(cal.season(F.col("period"), rules.seasons).alias("season")).agg(
        F.sum("revenue").alias("revenue")
    )


def register(warehouse: Warehouse, rules: Rules = DEFAULT_RULES) -> list[str]:
    """Make the tables and views known to ``spark.sql`` under their usual names. Bills are rows
    where the warehouse's grain check has found its ids unique.

    The concentration view ranks all customers and is computed here, once; the others are
    planned anew by each statement that reads them.
    """
    detail = sales_detail(warehouse)
    frames = warehouse.tables() | {
        "v_sales_detail": detail,
        "v_monthly_kpi": monthly_kpi(detail, rules, warehouse.unique_ids),
        "v_channel_mix": channel_mix(detail, rules),
        "v_customer_concentration": customer_concentration(detail),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
