"""Customer segments from recency, frequency, monetary value and each buyer's own rhythm.

A customer who buys once a year is not lapsed after eleven months. Recency is therefore
also read against the customer's own average gap between purchases.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom import rules as r
from martloom.functions.rounding import half_even, ratio
from martloom.operators.attach import attach
from martloom.operators.bills import with_bills
from martloom.operators.scratch import materialize
from martloom.operators.selection import median, with_quantile_scores
from martloom.rules import DEFAULT_RULES, Rules

CUSTOMER_COLUMNS = [
    "customer_id", "last_purchase", "first_purchase", "frequency", "monetary",
    "recency_days", "tenure_days", "avg_gap_days", "expected_gap", "overdue_ratio",
    "R", "F", "M", "rfm_score", "avg_order_value", "segment",
]


class SegmentRun(NamedTuple):
    customers: DataFrame
    segments: DataFrame


def purchase_history(detail: DataFrame, unique_ids: bool = False) -> DataFrame:
    """One row per customer. ``unique_ids`` counts rows where ids are known to be unique."""
    sums = [
        F.max("date_key").alias("last_purchase"),
        F.min("date_key").alias("first_purchase"),
        F.sum("net_amount").alias("monetary"),
    ]
    history = with_bills(detail, ["customer_id"], sums, unique_ids)
    return history.withColumnRenamed("bills", "frequency")


def with_scores(history: DataFrame, bins: int = 5) -> DataFrame:
    """R, F and M from 1 to ``bins``; ties go by customer id.

    The oldest last purchase ranks lowest, so R needs no as-of date. ``history`` is scanned
    several times for the boundaries: pass a written table.
    """
    measures = {"R": "last_purchase", "F": "frequency", "M": "monetary"}
    orders = {name: [F.col(m), F.col("customer_id")] for name, m in measures.items()}
    return with_quantile_scores(history, orders, bins)


def _gap_days() -> Column:
    """Days on the books per repeat purchase; NULL for one-time buyers."""
    return ratio(F.datediff("_as_of", "first_purchase"), F.col("frequency") - 1)


def _overdue_ratio() -> Column:
    """Days since the last purchase over the expected gap. A zero gap makes any wait overdue
    without bound, and no wait undefined."""
    recency, gap = F.col("recency_days"), F.col("expected_gap")
    endless = F.signum(recency.cast("double")) * F.lit(float("inf"))
    return F.when((gap == 0) & (recency != 0), endless).otherwise(half_even(ratio(recency, gap)))


def segment(rules: Rules = DEFAULT_RULES) -> Column:
    """The action for a customer: the first rule that holds. A NULL ratio is not overdue."""
    recent, often, big = F.col("R") >= 4, F.col("F") >= 4, F.col("M") >= 4
    stale, seldom, small = F.col("R") <= 2, F.col("F") <= 2, F.col("M") <= 2
    overdue = F.col("overdue_ratio") >= rules.overdue_from
    return (
        F.when(recent & often & big, r.SEGMENT_CHAMPIONS)
        .when(big & overdue, r.SEGMENT_OVERDUE)
        .when(recent & seldom, r.SEGMENT_NEW)
        .when(often & stale, r.SEGMENT_SLIPPING)
        .when(stale & small, r.SEGMENT_DORMANT)
        .when(big, r.SEGMENT_BIG_SPENDER)
        .otherwise(r.SEGMENT_MIDDLE)
    )


def build(
    detail: DataFrame,
    as_of: dt.date | None = None,
    rules: Rules = DEFAULT_RULES,
    unique_ids: bool = False,
) -> DataFrame:
    """Score and segment every customer. ``as_of`` defaults to the last sale; later sales
    still count when it is set earlier, so recency can be negative."""
    history = materialize(purchase_history(detail, unique_ids), "history")
    if as_of is None:
        today = history.agg(F.max("last_purchase").alias("_as_of"))
    else:
        today = history.agg(F.lit(as_of).alias("_as_of"))
    today = materialize(today, "today")
    usual_gap = F.lit(median(attach(history, today), _gap_days())).cast("double")
    return (
        attach(with_scores(history), today)
        .withColumns(
            {
                "recency_days": F.datediff("_as_of", "last_purchase"),
                "tenure_days": F.datediff("_as_of", "first_purchase"),
                "avg_gap_days": _gap_days(),
            }
        )
        .withColumn("expected_gap", F.coalesce("avg_gap_days", usual_gap))
        .withColumns(
            {
                "overdue_ratio": _overdue_ratio(),
                "rfm_score": F.col("R") + F.col("F") + F.col("M"),
                "avg_order_value": half_even(ratio(F.col("monetary"), F.col("frequency"))),
            }
        )
        .withColumn("segment", segment(rules))
        .select(*CUSTOMER_COLUMNS)
    )


def by_value(customers: DataFrame) -> DataFrame:
    """Highest monetary value first, for reading and export."""
    return customers.orderBy(F.desc("monetary"), "customer_id")


def summary(customers: DataFrame) -> DataFrame:
    """One row per segment, highest revenue first."""
    everyone = Window.partitionBy()  # seven segments at most
    count, revenue = F.col("customers"), F.col("revenue")
    order_values = F.sum(F.col("avg_order_value").cast("decimal(28,2)"))
    return (
        customers.groupBy("segment")
        .agg(
            F.count("*").alias("customers"),
            F.sum("monetary").alias("revenue"),
            half_even(ratio(order_values, F.count("avg_order_value"))).alias("avg_order_value"),
            half_even(ratio(F.sum("frequency"), F.count("*"))).alias("avg_orders"),
            # whole days: the value map is bounded by the length of the calendar
            half_even(F.median("recency_days")).alias("median_days_since"),
        )
        .withColumns(
            {
                "pct_of_customers": half_even(
                    ratio(count, F.sum(count).over(everyone)) * 100.0, 1
                ),
                "pct_of_revenue": half_even(
                    ratio(revenue, F.sum(revenue).over(everyone)) * 100.0, 1
                ),
                "revenue_per_customer": half_even(ratio(revenue, count), 0),
            }
        )
        .orderBy(F.desc("revenue"), "segment")
    )


def by_revenue_share(segments: DataFrame) -> DataFrame:
    """Chart order: smallest share of revenue first."""
    return segments.orderBy("pct_of_revenue", "segment")


def run(
    detail: DataFrame,
    as_of: dt.date | None = None,
    rules: Rules = DEFAULT_RULES,
    unique_ids: bool = False,
) -> SegmentRun:
    """Customers are written once and serve both results."""
    customers = materialize(build(detail, as_of, rules, unique_ids), "customers")
    return SegmentRun(by_value(customers), summary(customers))
