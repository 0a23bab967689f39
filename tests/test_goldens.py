"""Replays of published inputs with published results."""

from __future__ import annotations

import datetime as dt

import pytest

from martloom import rules
from martloom.plans import forecasting, variance

# Fixed values from here on: published inputs and the results published for them.

# Monthly revenue, April 2024 to March 2026.
REVENUE = """
8148208.18 8021258.31 5813690.33 4385257.76 3759418.90 7278702.76
11449258.87 10114781.34 7930192.20 9654585.02 6258986.73 6994714.93
9615588.08 9499020.03 5997623.96 4330993.89 5146837.05 7455777.93
12910925.08 11271023.25 7915357.17 10714586.90 6248374.07 7966938.84
""".split()

FORECAST = [
    (dt.date(2026, 4, 1), 10994701.90, 10567550.46, 11421853.34),
    (dt.date(2026, 5, 1), 10244164.83, 9817013.39, 10671316.26),
    (dt.date(2026, 6, 1), 6757589.09, 6330437.65, 7184740.53),
    (dt.date(2026, 7, 1), 5009259.67, 4582108.24, 5436411.11),
    (dt.date(2026, 8, 1), 5025175.93, 4598024.49, 5452327.37),
    (dt.date(2026, 9, 1), 8490782.25, 8063630.82, 8917933.69),
]

INDICES = [1.2658, 0.7576, 0.8711, 1.2550, 1.1602, 0.7594, 0.5586, 0.5561, 0.9325, 1.5354, 1.3478, 1.0005]

# category, budget and actual units, budget and actual revenue, price, volume, mix, achievement
VARIANCE = [
    ("Silk Saree", 3507, 3384, "43859001.86", "42446079.74", 125332.01, -680705.81, -857548.32, 96.8),
    ("Cotton Saree", 8615, 8501, "12297933.28", "12104906.17", -30291.84, -190867.88, 28132.60, 98.4),
    ("Readymade", 6233, 6106, "13736337.33", "13603678.40", 147224.73, -213192.37, -66691.29, 99.0),
    ("Accessories", 5589, 5398, "2317098.13", "2261070.80", 23157.81, -35962.11, -43223.03, 97.6),
    ("Kids Wear", 3987, 3905, "3831478.97", "3781919.83", 29242.28, -59465.79, -19335.64, 98.7),
    ("Fancy Saree", 7893, 7974, "24530881.94", "24875391.31", 92767.14, -380727.18, 632469.41, 101.4),
]


@pytest.fixture(scope="module")
def series(spark):
    months = [dt.date(2024 + (m + 3) // 12, (m + 3) % 12 + 1, 1) for m in range(24)]
    text = spark.createDataFrame(list(zip(months, REVENUE, strict=True)), "period date, r string")
    return text.selectExpr("period", "cast(r as decimal(28,2)) as revenue")


@pytest.fixture(scope="module")
def decomposed(spark):
    rows = [row[:5] for row in VARIANCE]
    text = spark.createDataFrame(rows, "category string, qb int, qa int, rb string, ra string")
    budget = text.selectExpr(
        "category", "qb as budget_qty", "cast(rb as decimal(28,2)) as budget_revenue"
    )
    actual = text.selectExpr(
        "category", "qa as actual_qty", "cast(ra as decimal(28,2)) as actual_revenue"
    )
    return variance.decompose(actual, budget)


def test_forecast(series):
    rows = forecasting.fit_predict(series).orderBy("period").collect()
    assert [tuple(row) for row in rows] == FORECAST


def test_seasonal_indices(series):
    rows = forecasting.seasonal_indices(series).orderBy("month").collect()
    assert [row.seasonal for row in rows] == INDICES
    assert sum(row.seasonal for row in rows) / 12 == pytest.approx(1.0, abs=0.01)


def test_weakest_months_and_peak(series):
    indices = forecasting.seasonal_indices(series)
    (low,) = forecasting.weakest_month(indices).collect()
    assert low.month in (7, 8)
    assert indices.where("month = 10").first().seasonal > 1.2


def test_backtest(series):
    (row,) = forecasting.backtest(series).collect()
    assert row.asDict() == {
        "status": rules.STATUS_OK,
        "holdout_months": 6,
        "model_months": 6,
        "naive_months": 6,
        "model_mape_pct": 5.62,
        "seasonal_naive_mape_pct": 7.34,
        "improvement_pct_points": 1.72,
        "verdict": rules.VERDICT_MODEL,
    }


def test_intervals_are_ordered(series):
    assert all(r.lower_80 < r.forecast < r.upper_80 for r in forecasting.fit_predict(series).collect())


def test_variance_rows(decomposed):
    rows = {row.category: row for row in decomposed.collect()}
    for category, qb, qa, _, _, price, volume, mix, achieved in VARIANCE:
        row = rows[category]
        assert (row.budget_qty, row.actual_qty) == (qb, qa)
        assert float(row.price_variance) == pytest.approx(price, abs=0.011)
        assert float(row.volume_variance) == pytest.approx(volume, abs=0.011)
        assert float(row.mix_variance) == pytest.approx(mix, abs=0.011)
        assert row.achievement_pct == achieved
    assert [row.category for row in decomposed.collect()] == [row[0] for row in VARIANCE]


def test_bridge(decomposed):
    rows = variance.bridge(decomposed).orderBy("step_no").collect()
    published = [100572731.51, 387432.13, -1560921.14, -326196.27, 99073046.23]
    for row, value in zip(rows, published, strict=True):
        assert float(row.value) == pytest.approx(value, abs=0.05)
    assert [row.step for row in rows] == [
        rules.STEP_BUDGET, rules.STEP_PRICE, rules.STEP_VOLUME, rules.STEP_MIX, rules.STEP_ACTUAL,
    ]


def test_reconciliation(decomposed):
    (row,) = variance.reconciliation_error(decomposed).collect()
    assert float(row.reconciliation_error) <= 0.05
    (miss,) = variance.largest_miss(decomposed).collect()
    assert miss.category == "Silk Saree"


def test_waterfall(decomposed):
    bars = variance.waterfall(variance.bridge(decomposed)).orderBy("step_no").collect()
    assert [bar.direction for bar in bars] == ["total", "up", "down", "down", "total"]
    assert bars[0].bottom == 0 and bars[-1].bottom == 0
    assert bars[2].bottom == pytest.approx(bars[0].height + bars[1].height)
    assert bars[3].bottom + bars[3].height == pytest.approx(bars[4].height)
