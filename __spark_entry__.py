"""

Every query runs over the whole order-line tables of ``sf_dir``, read through the retail
adapter. The plan for FISCAL_YEAR is built from the actuals of PRIOR_YEAR.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import martloom_sql  # noqa: E402
from martloom.functions import calendar as cal  # noqa: E402
from martloom.operators import contracts  # noqa: E402
from martloom.operators import dimensions as dims  # noqa: E402
from martloom.operators.scratch import materialize, scope, scratch_path  # noqa: E402
from martloom.plans import (  # noqa: E402
    customers,
    forecasting,
    planning,
    summary,
    variance,
    views,
    warehouse,
)
from martloom.sinks import exports  # noqa: E402
from martloom.sources import extracts, order_lines  # noqa: E402
from martloom.sources.order_lines import ORDER_RULES  # noqa: E402

PRIOR_YEAR = "FY1998-99"
FISCAL_YEAR = "FY1999-00"
AS_OF = dt.date(2000, 6, 30)

Query = Callable[[SparkSession, str], DataFrame]

# The text operators are an optional part: without their files the rest works as before.
_OPTIONAL = ("corpus_pipeline", "martloom.llm", "martloom.llm.registry")
try:
    import martloom.llm.registry as llm
except ModuleNotFoundError as missing:
    if missing.name not in _OPTIONAL:
        raise
    llm = None


def _comparable(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE: engines name the precision of a sum differently."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines.read_transactions(spark, sf_dir)


def _sales(spark: SparkSession, sf_dir: str, fiscal_year: str | None = None) -> DataFrame:
    """Sales lines, of one fiscal year if given: the dates then reach the scan."""
    since, until = cal.fiscal_bounds(fiscal_year, ORDER_RULES) if fiscal_year else (None, None)
    return views.flat_sales(
        order_lines.read_transactions(spark, sf_dir, since, until),
        order_lines.read_stores(spark, sf_dir, with_city=False),
    )


def _plan(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    prior = _sales(spark, sf_dir, PRIOR_YEAR)
    return planning.build_plan(prior, PRIOR_YEAR, keys=keys, rules=ORDER_RULES)


def _variance(
    spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()
) -> variance.VarianceRun:
    actual = _sales(spark, sf_dir, FISCAL_YEAR)
    return variance.run(actual, _plan(spark, sf_dir, keys), FISCAL_YEAR, keys, ORDER_RULES)


def _series(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return materialize(forecasting.monthly_series(_sales(spark, sf_dir), keys), "series")


def _built(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """Profile, customers, fact and plan all read the lines: they are joined once."""
    lines = order_lines.written_transactions(spark, sf_dir)
    sales = views.flat_sales(lines, order_lines.read_stores(spark, sf_dir, with_city=False))
    return warehouse.build(
        lines,
        order_lines.read_stores(spark, sf_dir),
        planning.build_plan(sales, PRIOR_YEAR, rules=ORDER_RULES),
        ORDER_RULES,
    )


def _stored(spark: SparkSession, sf_dir: str) -> warehouse.Warehouse:
    """The star schema written to the shared folder and read back. Each query stores its own, so
    its work does not depend on what ran before it, and it reads the tables as they are now."""
    return _saved(spark, sf_dir, check_grain=False)


def _saved(spark: SparkSession, sf_dir: str, check_grain: bool) -> warehouse.Warehouse:
    folder = scratch_path(spark, "warehouse")
    with scope():  # what the build has written on the way is not needed by the stored star
        warehouse.save(_built(spark, sf_dir), folder, check_grain=check_grain)
    return warehouse.load(spark, folder)


# --- dimensions and fact ------------------------------------------------------------


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date(_transactions(spark, sf_dir), ORDER_RULES)


def q_dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_store(order_lines.read_stores(spark, sf_dir))


def q_dim_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_category(_transactions(spark, sf_dir), ORDER_RULES)


def q_dim_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_channel(_transactions(spark, sf_dir), ORDER_RULES)


def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_customer(_transactions(spark, sf_dir))


def q_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir).fact_sales


def q_sales_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sales_detail(_built(spark, sf_dir))


def q_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.load_totals(_transactions(spark, sf_dir))


def q_stored_load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals as observed while the fact was written."""
    return warehouse.stored_totals(_stored(spark, sf_dir))


def q_stored_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of the stored star schema."""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in _stored(spark, sf_dir).tables().items()
    ]
    return reduce(DataFrame.unionByName, counts)


def q_stored_year_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fiscal year of the stored detail view: the calendar filter prunes folders."""
    detail = views.sales_detail(_stored(spark, sf_dir)).where(F.col("fiscal_year") == FISCAL_YEAR)
    return detail.groupBy("fiscal_year", "category", "price_band", "channel").agg(
        F.count("*").alias("lines"), F.sum("net_amount").alias("revenue")
    )


def q_channel_by_month_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which channel sells how much, in which month, for which category: plain SQL."""
    views.sales_detail(_built(spark, sf_dir)).createOrReplaceTempView("v_sales_detail")
    return spark.sql(
        """
        SELECT fiscal_year, fiscal_month, month_name, category, channel,
               SUM(quantity) AS units, SUM(net_amount) AS revenue
        FROM v_sales_detail
        GROUP BY fiscal_year, fiscal_month, month_name, category, channel
        """
    )


def q_extract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.extract_checks(_transactions(spark, sf_dir))


def q_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir)
    return contracts.contract_report(
        stored.tables(), ORDER_RULES, stored.extract_rows, stored.observed
    )


# --- reporting views ----------------------------------------------------------------


def q_monthly_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.monthly_kpi(_sales(spark, sf_dir), ORDER_RULES)


def q_channel_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.channel_mix(_sales(spark, sf_dir), ORDER_RULES)


def q_customer_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.customer_concentration(_sales(spark, sf_dir))


def q_concentration_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.cumulative_concentration(views.customer_concentration(_sales(spark, sf_dir)))


def q_monthly_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = dims.dim_category(_transactions(spark, sf_dir), ORDER_RULES)
    return views.monthly_grain(_sales(spark, sf_dir), categories, ORDER_RULES)


def q_monthly_grain_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On a stored warehouse: its grain check has found the ids unique, so bills are rows."""
    stored = _saved(spark, sf_dir, check_grain=True)
    detail = views.sales_detail(stored)
    return views.monthly_grain(detail, rules=ORDER_RULES, unique_ids=stored.unique_ids)


def q_season_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.season_rollup(_sales(spark, sf_dir), ORDER_RULES)


# --- plan and variance --------------------------------------------------------------


def q_budget_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir)


def q_actuals_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.actuals_by_category(
        _sales(spark, sf_dir, FISCAL_YEAR), FISCAL_YEAR, rules=ORDER_RULES
    )


def q_budget_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.budget_by_category(_plan(spark, sf_dir), FISCAL_YEAR)


def q_variance_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variance(spark, sf_dir).by_category


def q_variance_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variance(spark, sf_dir, ("store_id",)).by_category


def q_variance_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variance(spark, sf_dir).bridge


def q_bridge_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _variance(spark, sf_dir, ("store_id",)).bridge


def q_waterfall_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("store_id",)
    return variance.waterfall(_variance(spark, sf_dir, keys).bridge, keys)


def q_variance_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.reconciliation_error(_variance(spark, sf_dir).by_category)


def q_largest_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.largest_miss(_variance(spark, sf_dir).by_category)


def q_waterfall_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variance.waterfall(_variance(spark, sf_dir).bridge)


# --- customers ----------------------------------------------------------------------


def q_rfm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.by_value(customers.build(_sales(spark, sf_dir), rules=ORDER_RULES))


def q_rfm_customers_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments as of a day before the last sale."""
    return customers.by_value(customers.build(_sales(spark, sf_dir), AS_OF, ORDER_RULES))


def q_rfm_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.summary(customers.build(_sales(spark, sf_dir), rules=ORDER_RULES))


def q_segment_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = customers.summary(customers.build(_sales(spark, sf_dir), rules=ORDER_RULES))
    return customers.by_revenue_share(segments).select(
        "segment", "pct_of_customers", "pct_of_revenue"
    )


# --- forecast -----------------------------------------------------------------------


def q_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.monthly_series(_sales(spark, sf_dir)).orderBy("period")


def q_seasonal_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.seasonal_indices(_series(spark, sf_dir))


def q_weakest_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.weakest_month(forecasting.seasonal_indices(_series(spark, sf_dir)))


def q_revenue_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.fit_predict(_series(spark, sf_dir))


def q_revenue_forecast_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.fit_predict(_series(spark, sf_dir), horizon=12)


def q_forecast_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecasting.backtest(_series(spark, sf_dir))


def q_history_and_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _series(spark, sf_dir)
    return forecasting.history_and_forecast(series, forecasting.fit_predict(series))


def q_forecast_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("category",)
    return forecasting.fit_predict(_series(spark, sf_dir, keys), keys=keys)


def q_backtest_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("category",)
    return forecasting.backtest(_series(spark, sf_dir, keys), keys=keys)


def q_indices_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("category",)
    return forecasting.seasonal_indices(_series(spark, sf_dir, keys), keys)


def q_forecast_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("store_id",)
    return forecasting.fit_predict(_series(spark, sf_dir, keys), keys=keys)


def q_backtest_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("store_id",)
    return forecasting.backtest(_series(spark, sf_dir, keys), keys=keys)


def q_filled_series_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without sales of a store as zero, the incomplete last month left out."""
    lines = _sales(spark, sf_dir)
    return forecasting.monthly_series(
        lines, ["store_id"], fill_gaps=True, drop_partial_last=True
    )


def q_filled_series_to_common_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, with every store's series up to the last whole month of all stores."""
    return forecasting.monthly_series(
        _sales(spark, sf_dir), ["store_id"], fill_gaps=True, drop_partial_last=True, to_common_end=True
    )


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = _variance(spark, sf_dir)
    return summary.run_summary(
        FISCAL_YEAR,
        variance.reconciliation_error(gap.by_category),
        gap.bridge,
        forecasting.backtest(_series(spark, sf_dir)),
    )


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested summary, written as JSON, read back and laid flat: a row per bridge step."""
    path = exports.write_json(_run_summary(spark, sf_dir), scratch_path(spark, "summary"))
    stored = spark.read.json(path)
    step = F.posexplode("bridge").alias("place", "step")
    flat = stored.select("fiscal_year", "reconciliation_error_inr", step, "backtest")
    backtest = [F.col(f"backtest.{name}") for name in summary.BACKTEST_FIELDS]
    return flat.select(
        "fiscal_year", "reconciliation_error_inr", "place", "step.step", "step.value",
        "step.kind", *backtest,
    )


# --- files --------------------------------------------------------------------------


def _as_csv(table: DataFrame, label: str) -> str:
    return exports.write_csv(table, scratch_path(table.sparkSession, label))


def q_csv_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines written as an extract and read with its declared schema."""
    lines = _transactions(spark, sf_dir).drop("transaction_key")
    return extracts.read_transactions(spark, _as_csv(lines, "tx"))


def q_csv_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    stores = order_lines.read_stores(spark, sf_dir)
    return extracts.read_stores(spark, _as_csv(stores, "stores"))


def q_csv_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.read_budget(spark, _as_csv(_plan(spark, sf_dir), "budget"))


def _exported(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the exported extracts, read back with the types it was written with."""
    stored = _stored(spark, sf_dir)
    detail = views.sales_detail(stored)
    folder = scratch_path(spark, "export")
    exports.export_extracts(detail, folder, ORDER_RULES)
    found = spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/{name}")
    counts = [c for c in ("bills", "customers", "units") if c in found.columns]
    return found.withColumns({c: F.col(c).cast("bigint") for c in counts})


def q_exported_monthly_kpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "v_monthly_kpi")


def q_exported_channel_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "v_channel_mix")


def q_exported_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "v_customer_concentration")


def q_exported_monthly_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir, "fact_monthly_grain")


def entry(spark: SparkSession) -> DataFrame:
    """Monthly KPIs on the smallest test tables."""
    return queries()["monthly_kpi"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}

    def checked(fn: Query) -> Query:
        return lambda spark, sf_dir: _comparable(fn(spark, sf_dir))

    text_queries = llm.queries() if llm else {}
    return {name: checked(fn) for name, fn in found.items()} | text_queries


def oracle_sql() -> dict[str, str]:
    checks = martloom_sql.statements(FISCAL_YEAR, PRIOR_YEAR, AS_OF)
    return checks | (llm.oracle_sql() if llm else {})
