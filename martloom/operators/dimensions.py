"""The five dimensions, each derived from the transactions (stores are given)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.operators.bills import with_bills
from martloom.operators.median import exact_median, histogram
from martloom.operators.scratch import materialize
from martloom.rules import DEFAULT_RULES, Rules
from martloom.schemas import DIM_DATE_COLUMNS, DIM_STORE_COLUMNS


def calendar_columns(days: DataFrame, day: str = "date_key", rules: Rules = DEFAULT_RULES) -> DataFrame:
    d = F.col(day)
    return days.withColumns(
        {
            "year": F.year(d),
            "month": F.month(d),
            "month_name": cal.month_name(d),
            "quarter": F.quarter(d),
            "day_of_week": F.weekday(d),  # Monday is 0
            "is_weekend": cal.is_weekend(d),
            "fiscal_year": cal.fiscal_year(d, rules.fiscal_start_month),
            "fiscal_month": cal.fiscal_month(d, rules.fiscal_start_month),
            "season": cal.season(d, rules.seasons),
        }
    )


def profile(transactions: DataFrame) -> DataFrame:
    """What dates, categories, channels and price bands need, in one pass over the lines.

    Two grouping sets: a row per (category, price) and a row per channel. Equal values
    collapse before the shuffle.
    """
    sets = [["category", "unit_price"], ["channel"]]
    return transactions.groupingSets(sets, "category", "unit_price", "channel").agg(
        (F.grouping("channel") == 0).alias("is_channel"),
        F.count("*").alias("rows"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )


def dim_date(transactions: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every day from the first to the last transaction, days without sales included."""
    day = "transaction_date"
    return date_table(transactions.agg(F.min(day).alias("first"), F.max(day).alias("last")), rules)


def date_table(span: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``span`` is one row with the ``first`` and ``last`` day."""
    days = span.select(F.explode(F.sequence("first", "last")).alias("date_key"))
    return calendar_columns(days, rules=rules).select(*DIM_DATE_COLUMNS)


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select(*DIM_STORE_COLUMNS)


def with_surrogate_key(names: DataFrame, name: str, key: str) -> DataFrame:
    """Number distinct names 1..n in sorted order, for dimensions of a few thousand names: one
    task sorts them. A missing name gets no key; the contracts report such lines. The result is
    a written table, so that joins with the fact know its true size."""
    number = F.row_number().over(Window.orderBy(name))
    named = names.where(F.col(name).isNotNull())
    return materialize(named.withColumn(key, number), name)


def dim_category(
    transactions: DataFrame, rules: Rules = DEFAULT_RULES, approx: bool = False
) -> DataFrame:
    """Categories with a price band taken from the median observed unit price.

    The median is exact. ``approx=True`` uses the mergeable sketch instead: one pass and
    less data, but the lower middle value and a small rank error, so bands may differ
    for a median close to a threshold.
    """
    if approx:
        medians = transactions.groupBy("category").agg(
            F.percentile_approx("unit_price", 0.5, 10000).cast("double").alias("median_price")
        )
        return _banded(medians, rules)
    return category_table(histogram(transactions, "unit_price", ["category"]), rules)


def category_table(prices: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``prices`` is a histogram of (category, unit_price)."""
    return _banded(exact_median(prices, "unit_price", ["category"], out="median_price"), rules)


def _banded(medians: DataFrame, rules: Rules) -> DataFrame:
    price = F.col("median_price")
    bands = medians.select(
        "category",
        F.when(price >= rules.premium_from, "Premium")
        .when(price >= rules.mid_from, "Mid")
        .otherwise("Value")
        .alias("price_band"),
    )
    return with_surrogate_key(bands, "category", "category_id").select(
        "category_id", "category", "price_band"
    )


def dim_channel(lines: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Channels found in ``lines`` (transactions or their profile)."""
    names = lines.select("channel").distinct()
    return with_surrogate_key(names, "channel", "channel_id").select(
        "channel_id",
        "channel",
        F.col("channel").isin(*rules.physical_channels).cast("int").alias("is_physical"),
    )


def dim_customer(transactions: DataFrame) -> DataFrame:
    sums = [
        F.min("transaction_date").alias("first_purchase"),
        F.max("transaction_date").alias("last_purchase"),
        F.sum("net_amount").alias("lifetime_value"),
    ]
    return with_bills(transactions, ["customer_id"], sums).select(
        "customer_id",
        "first_purchase",
        "last_purchase",
        F.col("bills").alias("lifetime_orders"),
        "lifetime_value",
    )
