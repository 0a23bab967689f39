"""Data contracts: one report row per rule with the number of violations."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions.rounding import half_up, percent
from martloom.operators import bills
from martloom.operators.scratch import materialize
from martloom.rules import DEFAULT_RULES, Rules
from martloom.schemas import BUDGET, DIM_DATE_COLUMNS, FACT_COLUMNS, TRANSACTIONS

FOREIGN_KEYS = {
    "date_key": "dim_date",
    "store_id": "dim_store",
    "category_id": "dim_category",
    "channel_id": "dim_channel",
    "customer_id": "dim_customer",
}

PRIMARY_KEYS = {
    "dim_date": ["date_key"],
    "dim_store": ["store_id"],
    "dim_category": ["category_id"],
    "dim_channel": ["channel_id"],
    "dim_customer": ["customer_id"],
    "budget": ["fiscal_year", "month", "category"],
}

UNIQUE_NAMES = {"dim_category": "category", "dim_channel": "channel"}

REQUIRED = {
    "dim_date": DIM_DATE_COLUMNS[1:],
    "dim_store": ["store_name", "city"],
    "dim_category": ["category", "price_band"],
    "dim_channel": ["channel", "is_physical"],
    "budget": BUDGET.names[3:],
}


def _report(row: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Aggregate ``checks`` in one pass and turn the single row into one row per check."""
    row = row.agg(
        *[F.coalesce(v.cast("bigint"), F.lit(0)).alias(name) for name, v in checks.items()]
    )
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(f"`{name}`").alias("violations"))
            for name in checks
        ]
    )
    return row.select(F.inline(entries))


def _rows_where(bad: Column) -> Column:
    return F.sum(F.when(bad, 1).otherwise(0))


def extract_checks(transactions: DataFrame) -> DataFrame:
    """The same rules on the raw extract, before the key lookup: a line without a category or
    channel finds no key there and would drop out unseen."""
    return _line_report(transactions, "transactions", TRANSACTIONS.names)


def _line_rules(table: str, required: list[str]) -> dict[str, Column]:
    """What must not hold for any line."""
    share = F.col("discount_pct")
    rules = {f"{table}.{c} is null": F.col(c).isNull() for c in required}
    return rules | {
        f"{table}.quantity <= 0": F.col("quantity") <= 0,
        f"{table}.unit_price <= 0": F.col("unit_price") <= 0,
        f"{table}.discount_pct outside [0, 1)": (share < 0) | (share >= 1),
        f"{table}.net_amount <= 0": F.col("net_amount") <= 0,
    }


def _line_report(lines: DataFrame, table: str, required: list[str]) -> DataFrame:
    rules = _line_rules(table, required)
    return _report(lines, {name: _rows_where(bad) for name, bad in rules.items()})


LOST_LINES = "transactions not in fact_sales"
NO_ID = "fact_sales.transaction_id is null"  # as measured while the fact is written

STAR_KEYS = ["date_key", "store_id", "category_id", "channel_id"]


def line_measures() -> list[Column]:
    """Rows, revenue and broken line rules of the fact, to be observed while it is written."""
    rules = _line_rules("fact_sales", FACT_COLUMNS)
    return [
        F.count("*").alias("rows"),
        F.sum("net_amount").alias("revenue"),
        *[_rows_where(bad).alias(name) for name, bad in rules.items()],
    ]


def observed_checks(
    spark: SparkSession, observed: Mapping[str, Decimal], extract_rows: int | None = None
) -> DataFrame:
    """The line rules and the check for lost lines from what the write of the fact has observed."""
    rows = [(name, int(observed[name])) for name in _line_rules("fact_sales", FACT_COLUMNS)]
    if extract_rows is not None:
        rows.append((LOST_LINES, extract_rows - int(observed["rows"])))
    return spark.createDataFrame(rows, "check string, violations bigint")


def star_cells(fact: DataFrame, line_rules: bool = True) -> DataFrame:
    """One pass over the fact: rows, revenue and broken line rules per value of each of
    ``STAR_KEYS`` by itself; ``of`` names the key. There are as many cells as the dimensions have
    rows, while combinations of the keys may be as many as the lines."""
    rules = _line_rules("fact_sales", FACT_COLUMNS) if line_rules else {}
    of = F.coalesce(*[F.when(F.grouping(key) == 0, F.lit(key)) for key in STAR_KEYS])
    return fact.groupingSets([[key] for key in STAR_KEYS], *STAR_KEYS).agg(
        of.alias("of"),
        F.count("*").alias("rows"),
        F.sum("net_amount").alias("revenue"),
        *[_rows_where(bad).alias(name) for name, bad in rules.items()],
    )


def _cells_of(star: DataFrame, key: str) -> DataFrame:
    """The cells of one key, which hold every line once."""
    return star.where(F.col("of") == key)


def line_checks(star: DataFrame) -> DataFrame:
    """NOT NULL and domain rules of the fact, from its :func:`star_cells`."""
    rules = _line_rules("fact_sales", FACT_COLUMNS)
    cells = _cells_of(star, "date_key")
    return _report(cells, {name: F.sum(F.col(f"`{name}`")) for name in rules})


def completeness_check(star: DataFrame, extract_rows: int) -> DataFrame:
    """Lines of the extract that found no key and are not in the fact."""
    lost = F.lit(extract_rows) - F.coalesce(F.sum("rows"), F.lit(0))
    return _report(_cells_of(star, "date_key"), {LOST_LINES: lost})


def grain_check(fact: DataFrame) -> DataFrame:
    """Rows beyond one per transaction id. Only rows whose id hash repeats are looked at by id."""
    return _report(bills.repeats(fact), {"fact_sales.transaction_id repeats": F.sum("repeats")})


def orphan_checks(tables: Mapping[str, DataFrame], star: DataFrame | None = None) -> DataFrame:
    """Fact rows whose key is missing in a dimension, per foreign key.

    Rows are counted per key before the join: a dimension meets each key once, however many
    lines a hot key has. The small keys are counted over ``star``.
    """
    star = star_cells(tables["fact_sales"]) if star is None else star
    buyers = tables["fact_sales"].groupBy("customer_id").agg(F.count("*").alias("rows"))
    orphans = []
    for key, dim in FOREIGN_KEYS.items():
        counted = buyers if key == "customer_id" else _cells_of(star, key)
        missing = counted.join(tables[dim].select(key), key, "left_anti")
        orphans.append(_report(missing, {f"fact_sales.{key} not in {dim}": F.sum("rows")}))
    return reduce(DataFrame.unionByName, orphans)


def table_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per dimension and the budget, in one pass each: missing or repeated keys, repeated
    names, and missing values in required columns."""
    reports = []
    for name, keys in PRIMARY_KEYS.items():
        no_key = _any_null(keys)
        whole_keys = F.sum(F.when(no_key, 0).otherwise(1))
        checks = {
            f"{name} key is null": _rows_where(no_key),
            # a distinct count passes over keys with a NULL in them
            f"{name} key repeats": whole_keys - F.count_distinct(*keys),
        }
        if name in UNIQUE_NAMES:
            column = UNIQUE_NAMES[name]
            checks[f"{name}.{column} repeats"] = F.count(column) - F.count_distinct(column)
        if name in REQUIRED:
            checks[f"{name} has a null"] = _rows_where(_any_null(REQUIRED[name]))
        reports.append(_report(tables[name], checks))
    return reduce(DataFrame.unionByName, reports)


def _any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def budget_checks(budget: DataFrame) -> DataFrame:
    """Revenue planned without units has no price to compare with."""
    bad = (F.col("budget_qty") == 0) & (F.col("budget_revenue") > 0)
    return _report(budget, {"budget revenue without units": _rows_where(bad)})


def tie_out_checks(
    tables: Mapping[str, DataFrame], star: DataFrame, tolerance: float = 1.0
) -> DataFrame:
    """Revenue of the star join against the fact, and channel shares against 100 percent per
    year. The join goes to one written row per year and channel."""
    joined = (
        tables["fact_sales"].select(*STAR_KEYS, "net_amount")
        .join(tables["dim_date"].select("date_key", "fiscal_year"), "date_key")
        .join(tables["dim_store"].select("store_id"), "store_id")
        .join(tables["dim_category"].select("category_id"), "category_id")
        .join(tables["dim_channel"].select("channel_id", "channel"), "channel_id")
        .groupBy("fiscal_year", "channel")
        .agg(F.sum("net_amount").alias("revenue"))
    )
    mix = materialize(joined, "mix")
    both = _cells_of(star, "date_key").agg(F.sum("revenue").alias("fact")).withColumn(
        "view", mix.agg(F.sum("revenue")).scalar()
    )
    gap = F.abs(F.col("fact") - F.coalesce("view", F.lit(0))) > tolerance
    revenue = _report(both, {"monthly_kpi revenue differs from fact_sales": _rows_where(gap)})
    total = F.sum("revenue").over(Window.partitionBy("fiscal_year"))  # a year's channels
    shares = mix.withColumn("share", half_up(percent(F.col("revenue"), total)))
    years = shares.groupBy("fiscal_year").agg(F.sum("share").alias("share"))
    off = F.abs(F.col("share") - 100) >= 0.1
    return revenue.unionByName(_report(years, {"channel_mix shares do not add to 100": _rows_where(off)}))


def calendar_checks(dim_date: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Days whose fiscal year or fiscal month does not turn with the start month."""
    start = rules.fiscal_start_month
    begun = F.col("year") - (F.col("month") < start).cast("int")
    label_off = F.col("fiscal_year") != cal.fiscal_label(begun)
    turn = (F.col("month") == start) != (F.col("fiscal_month") == 1)
    return _report(dim_date, {"dim_date fiscal calendar is off": _rows_where(label_off | turn)})


def contract_report(
    tables: Mapping[str, DataFrame],
    rules: Rules = DEFAULT_RULES,
    extract_rows: int | None = None,
    observed: Mapping[str, Decimal] | None = None,
) -> DataFrame:
    """All checks: ``(check, violations)``. A sound warehouse shows zero everywhere.

    The fact is read four times: for its cells, its star join, its ids and its customers.
    ``extract_rows`` adds the check for lines lost on the way from the extract. ``observed`` is
    what was measured while the fact was written: the cells then carry no line rules.
    """
    fact = tables["fact_sales"]
    star = materialize(star_cells(fact, line_rules=observed is None), "cells")
    if observed is not None:
        lines = [observed_checks(fact.sparkSession, observed, extract_rows)]
    elif extract_rows is not None:
        lines = [line_checks(star), completeness_check(star, extract_rows)]
    else:
        lines = [line_checks(star)]
    parts = [
        *lines,
        grain_check(fact),
        orphan_checks(tables, star),
        table_checks(tables),
        budget_checks(tables["budget"]),
        tie_out_checks(tables, star),
        calendar_checks(tables["dim_date"], rules),
    ]
    return reduce(DataFrame.unionByName, parts)
