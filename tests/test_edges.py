"""Hand-made frames for the corners of variance, segments and forecast."""

from __future__ import annotations

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom import rules
from martloom.plans import customers, forecasting, planning, variance, views

ACTUAL = "category string, actual_qty int, actual_revenue decimal(28,2)"
BUDGET = "category string, budget_qty int, budget_revenue decimal(28,2)"


def _decompose(spark, actual, budget):
    def frame(rows, schema):
        return spark.createDataFrame([(c, q, Decimal(r)) for c, q, r in rows], schema)

    rows = variance.decompose(frame(actual, ACTUAL), frame(budget, BUDGET)).collect()
    return {row.category: row for row in rows}


def test_only_the_price_moves(spark):
    rows = _decompose(
        spark, [("tea", 30, 105), ("salt", 8, 8)], [("tea", 30, 120), ("salt", 8, 8)]
    )
    assert (rows["tea"].price_variance, rows["salt"].price_variance) == (-15, 0)
    assert all(r.volume_variance == 0 == r.mix_variance for r in rows.values())


def test_a_plan_beyond_32_bits(spark):
    rows = [(dt.date(2024, 5, 2), "A", 2_000_000_000, Decimal("4000000000.00"))] * 3
    detail = spark.createDataFrame(
        rows, "date_key date, category string, quantity int, net_amount decimal(18,2)"
    )
    plan = planning.build_plan(detail, "FY2024-25")
    assert plan.first().budget_qty == 6_720_000_000
    assert variance.budget_by_category(plan, "FY2025-26").first().budget_qty == 6_720_000_000


def test_unbudgeted_and_unsold_categories(spark):
    rows = _decompose(spark, [("A", 10, 100), ("new", 5, 50)], [("A", 10, 100), ("gone", 4, 40)])
    assert rows["new"].price_variance == 50 and rows["new"].achievement_pct is None
    assert rows["new"].volume_variance == 0 and rows["new"].mix_variance == 0
    assert rows["gone"].price_variance == 0 and rows["gone"].achievement_pct == 0
    for row in rows.values():
        parts = row.price_variance + row.volume_variance + row.mix_variance
        assert parts == pytest.approx(row.total_variance, abs=Decimal("0.02"))


def test_nothing_sold_at_all(spark):
    row = _decompose(spark, [], [("A", 10, 100)])["A"]
    assert (row.total_variance, row.actual_qty) == (-100, 0)


def test_plan_uprates_last_year(spark):
    rows = [
        (dt.date(2024, 4, 5), "A", 3, Decimal("300.00")),
        (dt.date(2024, 4, 9), "A", 2, Decimal("155.00")),
        (dt.date(2025, 3, 31), "A", 25, Decimal("250.00")),
        (dt.date(2025, 4, 1), "A", 99, Decimal("9.00")),
    ]
    detail = spark.createDataFrame(
        rows, "date_key date, category string, quantity int, net_amount decimal(18,2)"
    )
    got = planning.build_plan(detail, "FY2024-25").orderBy("month").collect()
    assert [tuple(row) for row in got] == [
        ("FY2025-26", 3, "A", 28, Decimal("10.00"), Decimal("280.00")),
        ("FY2025-26", 4, "A", 6, Decimal("91.00"), Decimal("546.00")),
    ]


# --- segments -----------------------------------------------------------------------

LINES = "customer_id string, date_key date, transaction_id string, net_amount decimal(18,2)"


def _lines(spark, rows):
    return spark.createDataFrame(
        [(c, d, f"T{i}", Decimal(v)) for i, (c, d, v) in enumerate(rows)], LINES
    )


def _expected(rows):
    """Scores, gaps and overdue ratios straight from their definitions, for one as-of day."""
    visits = {}
    for customer, day, value in rows:
        visits.setdefault(customer, []).append((day, value))
    as_of = max(day for _, day, _ in rows)
    measures = {
        "R": {c: max(d for d, _ in v) for c, v in visits.items()},
        "F": {c: len(v) for c, v in visits.items()},
        "M": {c: sum(x for _, x in v) for c, v in visits.items()},
    }
    found = {c: {} for c in visits}
    for name, values in measures.items():
        placed = sorted(visits, key=lambda c: (values[c], c))
        cuts = [(len(placed) - 1) * k / 5 for k in (1, 2, 3, 4)]  # of the ranks 0, 1, ...
        for rank, c in enumerate(placed):
            found[c][name] = 1 + sum(rank > cut for cut in cuts)
    gaps = {
        c: (as_of - min(d for d, _ in v)).days / (len(v) - 1)
        for c, v in visits.items()
        if len(v) > 1
    }
    for c in visits:
        found[c]["gap"] = gaps.get(c)
        found[c]["expected"] = gaps.get(c, statistics.median(gaps.values()))
        waited = (as_of - measures["R"][c]).days
        found[c]["overdue"] = round(waited / found[c]["expected"], 2)
    return found


def test_segments_against_plain_python(spark):
    rng = random.Random(31)
    rows = []
    for c in range(97):  # many equal values, and one customer with a third of the lines
        first = dt.date(2023, 6, 10) + dt.timedelta(days=rng.choice([0, 30, 30, 75, 200]))
        for _ in range(110 if c == 11 else rng.choice([1, 1, 2, 4])):
            day = first + dt.timedelta(days=rng.randrange(140))
            rows.append((f"B{c:02d}", day, rng.choice([40, 40, 55])))
    want = _expected(rows)
    got = {row.customer_id: row for row in customers.build(_lines(spark, rows)).collect()}
    assert set(got) == set(want)
    for c, row in got.items():
        assert (row.R, row.F, row.M) == (want[c]["R"], want[c]["F"], want[c]["M"])
        assert row.avg_gap_days == (want[c]["gap"] and pytest.approx(want[c]["gap"]))
        assert row.expected_gap == pytest.approx(want[c]["expected"])
        assert row.overdue_ratio == pytest.approx(want[c]["overdue"], abs=0.011)


def test_only_one_time_buyers(spark):
    day = dt.date(2025, 1, 1)
    rows = [(f"C{i}", day + dt.timedelta(days=i), 10) for i in range(6)]
    built = customers.build(_lines(spark, rows)).collect()
    assert all(row.overdue_ratio is None for row in built)
    assert {row.R for row in built} == {1, 2, 3, 4, 5}


def test_one_customer(spark):
    (row,) = customers.build(_lines(spark, [("C1", dt.date(2025, 1, 1), 10)])).collect()
    assert (row.R, row.F, row.M, row.segment) == (1, 1, 1, rules.SEGMENT_DORMANT)


def test_an_early_as_of_date_keeps_later_sales(spark):
    rows = [("C1", dt.date(2025, 1, 1), 10), ("C1", dt.date(2025, 1, 11), 10)]
    (row,) = customers.build(_lines(spark, rows), as_of=dt.date(2025, 1, 6)).collect()
    assert (row.recency_days, row.tenure_days, row.frequency) == (-5, 5, 2)


def test_segments_partition_the_customers(spark, sf_dir):
    from __spark_entry__ import _sales

    built = customers.build(_sales(spark, sf_dir))
    summed = customers.summary(built).agg(F.sum("customers")).first()[0]
    ids = built.select("customer_id")
    assert summed == ids.count() == ids.distinct().count()


# --- forecast -----------------------------------------------------------------------


def _series(spark, values, skip=()):
    rows = [
        (dt.date(2020 + m // 12, m % 12 + 1, 1), Decimal(v))
        for m, v in enumerate(values)
        if m not in skip
    ]
    return spark.createDataFrame(rows, "period date, revenue decimal(28,2)")


def test_short_history_gets_a_status(spark):
    (row,) = forecasting.backtest(_series(spark, [100 + m for m in range(18)])).collect()
    assert row.status == rules.STATUS_TOO_SHORT and row.model_mape_pct is None
    (row,) = forecasting.backtest(_series(spark, [100 + m for m in range(19)])).collect()
    assert row.status == rules.STATUS_OK


def test_unseen_calendar_month_has_no_forecast(spark):
    rows = forecasting.fit_predict(_series(spark, [100 + m for m in range(10)])).collect()
    by_month = {row.period.month: row.forecast for row in rows}
    assert by_month[11] is None and by_month[12] is None and by_month[1] is not None


def test_too_short_for_any_index(spark):
    rows = forecasting.fit_predict(_series(spark, [5, 6, 7])).collect()
    assert len(rows) == 6 and all(row.forecast is None for row in rows)


def test_mixed_lengths_by_key(spark):
    long = _series(spark, [100 + 7 * (m % 12) + m for m in range(30)])
    short = _series(spark, [50, 60, 70])
    both = long.withColumn("shop", F.lit("a")).unionByName(short.withColumn("shop", F.lit("b")))
    rows = {row.shop: row for row in forecasting.backtest(both, keys=["shop"]).collect()}
    (alone,) = forecasting.backtest(long).collect()
    assert rows["b"].status == rules.STATUS_TOO_SHORT
    assert rows["a"].model_mape_pct == alone.model_mape_pct
    keyed = forecasting.fit_predict(both, keys=["shop"]).where("shop = 'a'").drop("shop")
    assert sorted(keyed.collect()) == sorted(forecasting.fit_predict(long).collect())


def test_gap_filling_and_partial_months(spark):
    rows = [
        (dt.date(2025, 1, 5), Decimal(10)),
        (dt.date(2025, 3, 31), Decimal(20)),
        (dt.date(2025, 4, 2), Decimal(5)),
    ]
    detail = spark.createDataFrame(rows, "date_key date, net_amount decimal(18,2)")
    plain = forecasting.monthly_series(detail)
    assert plain.count() == 3
    filled = forecasting.monthly_series(detail, fill_gaps=True).orderBy("period").collect()
    assert [int(row.revenue) for row in filled] == [10, 0, 20, 5]
    whole = forecasting.monthly_series(detail, drop_partial_last=True).orderBy("period").collect()
    assert [row.period.month for row in whole] == [1, 3]


def test_zero_months_are_left_out_of_the_error(spark):
    values = [100 + 7 * (m % 12) for m in range(30)]
    values[27] = 0
    (row,) = forecasting.backtest(_series(spark, values)).collect()
    assert row.status == rules.STATUS_OK and row.model_mape_pct is not None
    assert (row.model_months, row.naive_months) == (5, 5)


def test_a_held_out_month_without_a_forecast_is_no_success(spark):
    # December is seen in the last month only, so the training months give it no index
    values = [100 + 7 * (m % 12) for m in range(36)]
    (row,) = forecasting.backtest(_series(spark, values, skip=(11, 23))).collect()
    assert row.status == rules.STATUS_NO_FORECAST and row.verdict is None
    assert row.model_mape_pct is None and row.improvement_pct_points is None
    assert (row.holdout_months, row.model_months, row.naive_months) == (6, 5, 5)
    assert row.seasonal_naive_mape_pct is not None


def test_series_up_to_a_common_end(spark):
    rows = [("a", dt.date(2025, 1, 5), 1), ("b", dt.date(2025, 1, 9), 2), ("b", dt.date(2025, 4, 9), 3)]
    detail = spark.createDataFrame(
        [(s, d, Decimal(v)) for s, d, v in rows], "shop string, date_key date, net_amount decimal(18,2)"
    )
    own = forecasting.monthly_series(detail, ["shop"], fill_gaps=True)
    common = forecasting.monthly_series(detail, ["shop"], fill_gaps=True, to_common_end=True)
    assert own.where("shop = 'a'").count() == 1 and common.where("shop = 'a'").count() == 4
    assert common.where("shop = 'b'").count() == own.where("shop = 'b'").count() == 4


# --- views --------------------------------------------------------------------------


def test_monthly_cells_serve_variance_and_forecast(spark, sf_dir):
    from __spark_entry__ import FISCAL_YEAR, ORDER_RULES, _plan, _sales

    sales, plan = _sales(spark, sf_dir), _plan(spark, sf_dir)
    cells = views.monthly_cells(sales)
    assert cells.count() < sales.count()
    for work in (
        lambda lines: variance.run(lines, plan, FISCAL_YEAR, rules=ORDER_RULES).by_category,
        lambda lines: forecasting.run(lines).forecast,
        lambda lines: forecasting.run(lines).backtest,
    ):
        assert sorted(map(str, work(cells).collect())) == sorted(map(str, work(sales).collect()))


def test_unique_ids_shortcut_and_deciles(spark, sf_dir):
    from __spark_entry__ import _sales

    sales = _sales(spark, sf_dir)
    honest = views.monthly_kpi(sales).orderBy("year", "month").collect()
    quick = views.monthly_kpi(sales, unique_ids=True).orderBy("year", "month").collect()
    assert honest == quick  # the ids of these tables are unique
    deciles = views.customer_concentration(sales).collect()
    counts = [row.customers for row in deciles]
    assert max(counts) - min(counts) <= 1 and counts == sorted(counts, reverse=True)
