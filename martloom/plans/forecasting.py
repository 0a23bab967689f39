"""Monthly revenue forecast: seasonal indices, a straight trend, and an honest backtest.

Every function takes ``keys``; each key's months form one series, and all series run in the
same plan. A series has one row per month, so its windows stay small however many lines
lie behind it. Series frames are read several times: pass a written table, as
:func:`run` does.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from martloom import rules as r
from martloom.functions import calendar as cal
from martloom.functions.rounding import half_even, ratio
from martloom.operators.attach import attach
from martloom.operators.scratch import materialize


class ForecastRun(NamedTuple):
    series: DataFrame
    forecast: DataFrame
    indices: DataFrame
    backtest: DataFrame


def monthly_series(
    detail: DataFrame,
    keys: Sequence[str] = (),
    fill_gaps: bool = False,
    drop_partial_last: bool = False,
    to_common_end: bool = False,
) -> DataFrame:
    """Revenue per month. ``fill_gaps`` adds months without sales as zero, up to each key's own
    last month, or with ``to_common_end`` to the last month of all keys, so that a store that
    closed is not projected from its last sale; ``drop_partial_last`` leaves out a last month
    that stops before its final day."""
    keys = list(keys)
    series = detail.groupBy(*keys, cal.month_start(F.col("date_key")).alias("period")).agg(
        F.sum("net_amount").alias("revenue"), F.max("date_key").alias("_latest")
    )
    if fill_gaps or drop_partial_last:
        series = materialize(series, "months")  # read more than once below
    if drop_partial_last:
        end = series.groupBy().agg(F.max("_latest").alias("_end"))
        series = attach(series, end).where(F.last_day("period") <= F.col("_end"))
    series = series.select(*keys, "period", "revenue")
    if fill_gaps:
        months = F.sequence(F.min("period"), F.max("period"), F.expr("interval 1 month"))
        if to_common_end:
            last = series.groupBy().agg(F.max("period").alias("_end"))
            starts = attach(series.groupBy(*keys).agg(F.min("period").alias("_start")), last)
            months = F.sequence("_start", "_end", F.expr("interval 1 month"))
            spans = starts.select(*keys, months.alias("months"))
        else:
            spans = series.groupBy(*keys).agg(months.alias("months"))
        every = spans.select(*keys, F.explode("months").alias("period"))
        series = every.join(series, [*keys, "period"], "left").na.fill(0, ["revenue"])
    return series


def _in_order(keys: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("period")


def seasonal_indices(
    series: DataFrame, keys: Sequence[str] = (), period_len: int = r.SEASON_LENGTH
) -> DataFrame:
    """Mean ratio of each calendar month to a centred moving average, scaled to mean 1.

    The frame takes ``period_len`` rows around the month, one more before than after, and
    needs half of them to be there.
    """
    keys = list(keys)
    frame = _in_order(keys).rowsBetween(-(period_len // 2), (period_len - 1) // 2)
    seen = F.count("revenue").over(frame)
    trend = F.when(seen >= period_len // 2, ratio(F.sum("revenue").over(frame), seen))
    by_month = (
        series.withColumn("_ratio", ratio(F.col("revenue"), trend))
        .groupBy(*keys, F.month("period").alias("month"))
        .agg(F.avg("_ratio").alias("_mean"))
        .where(F.col("_mean").isNotNull())
    )
    all_months = Window.partitionBy(*keys)  # twelve rows
    level = F.avg("_mean").over(all_months)
    return by_month.select(
        *keys, "month", half_even(ratio(F.col("_mean"), level), 4).alias("seasonal")
    )


def _fit(series: DataFrame, indices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: trend line through the deseasonalised months, and the residual spread."""
    keys = list(keys)
    months = (
        series.withColumns(
            {
                "_x": (F.row_number().over(_in_order(keys)) - 1).cast("double"),
                "month": F.month("period"),
                "_y": F.col("revenue").cast("double"),
            }
        )
        .join(indices, [*keys, "month"], "left")
        .withColumn("_flat", ratio(F.col("_y"), F.col("seasonal")))
    )
    complete = F.count("*") == F.count("_flat")  # one month without an index spoils the fit
    line = months.groupBy(*keys).agg(
        F.when(complete, F.regr_slope("_flat", "_x")).alias("_slope"),
        F.when(complete, F.regr_intercept("_flat", "_x")).alias("_intercept"),
        F.count("*").alias("_n"),
        F.max("period").alias("_last"),
    )
    expected = (F.col("_intercept") + F.col("_slope") * F.col("_x")) * F.col("seasonal")
    spread = (
        attach(months, line, keys)
        .groupBy(*keys)
        .agg(F.stddev_samp(F.col("_y") - expected).alias("_sigma"))
    )
    return attach(line, spread, keys)


def _project(
    series: DataFrame, horizon: int, keys: Sequence[str], period_len: int = r.SEASON_LENGTH
) -> DataFrame:
    keys = list(keys)
    indices = seasonal_indices(series, keys, period_len)
    ahead = (
        _fit(series, indices, keys)
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("period", F.add_months("_last", F.col("step")))
        .withColumn("month", F.month("period"))
        .join(indices, [*keys, "month"], "left")
    )
    x = (F.col("_n") - 1 + F.col("step")).cast("double")
    point = (F.col("_intercept") + F.col("_slope") * x) * F.col("seasonal")
    band = r.BAND_SIGMAS * F.col("_sigma")
    return ahead.select(
        *keys,
        "step",
        "period",
        half_even(point).alias("forecast"),
        half_even(point - band).alias("lower_80"),
        half_even(point + band).alias("upper_80"),
    )


def fit_predict(
    series: DataFrame, horizon: int = r.HORIZON_MONTHS, keys: Sequence[str] = ()
) -> DataFrame:
    """The next ``horizon`` months per series, with an 80 % band of the residual spread.

    Months whose calendar month has no index come back with NULL numbers.
    """
    return _project(series, horizon, keys).drop("step")


def backtest(
    series: DataFrame, holdout: int = r.HOLDOUT_MONTHS, keys: Sequence[str] = ()
) -> DataFrame:
    """Train without the last ``holdout`` months and compare with the same month last year.

    One row per series. Too short a series gets a status instead of numbers. Months with zero
    revenue have no percentage error and are left out. ``model_months`` and ``naive_months``
    count the months behind each of the two rates. If the model has no forecast for a month
    that has an error, its rate is NULL and the status says so.
    """
    keys = list(keys)
    latest_first = Window.partitionBy(*keys).orderBy(F.desc("period"))
    whole = Window.partitionBy(*keys)
    placed = series.withColumns(
        {
            "_back": F.row_number().over(latest_first),
            "_months": F.count("*").over(whole),
            "_actual": F.col("revenue").cast("double"),
        }
    )
    enough = F.col("_months") > holdout + r.SEASON_LENGTH
    train = placed.where(enough & (F.col("_back") > holdout)).select(*keys, "period", "revenue")
    test = placed.where(enough & (F.col("_back") <= holdout)).select(
        *keys, "period", "_actual", (holdout + 1 - F.col("_back")).alias("step")
    )
    predicted = _project(train, holdout, keys).select(*keys, "step", "forecast")
    year_ago = series.select(
        *keys,
        F.add_months("period", 12).alias("period"),
        F.col("revenue").cast("double").alias("_naive"),
    )
    due = F.count_if(F.col("_actual") != 0)
    errors = (
        test.join(predicted, [*keys, "step"], "left")
        .join(year_ago, [*keys, "period"], "left")
        .groupBy(*keys)
        .agg(
            F.when(due == _months("forecast"), _mape(F.col("forecast"))).alias("_model"),
            _mape(F.col("_naive")).alias("_base"),
            _months("forecast").alias("model_months"),
            _months("_naive").alias("naive_months"),
            (due == _months("forecast")).alias("_whole"),
            F.count("*").alias("_tested"),
        )
        .where("_tested > 0")  # without keys there is a row even if no series was tested
    )
    model, base = F.col("_model"), F.col("_base")
    scored = errors.select(
        *keys,
        F.when(F.col("_whole"), r.STATUS_OK).otherwise(r.STATUS_NO_FORECAST).alias("status"),
        F.lit(holdout).alias("holdout_months"),
        "model_months",
        "naive_months",
        half_even(model).alias("model_mape_pct"),
        half_even(base).alias("seasonal_naive_mape_pct"),
        half_even(base - model).alias("improvement_pct_points"),
        F.when(model < base, r.VERDICT_MODEL)
        .when(F.col("_whole"), r.VERDICT_NAIVE)
        .alias("verdict"),
    )
    too_short = (
        placed.groupBy(*keys)
        .agg(F.count("*").alias("_months"))
        .where(~enough)
        .select(*keys, F.lit(r.STATUS_TOO_SHORT).alias("status"))
    )
    return scored.unionByName(too_short, allowMissingColumns=True)


def _months(guess: str) -> Column:
    return F.count_if((F.col("_actual") != 0) & F.col(guess).isNotNull())


def _mape(guess: Column) -> Column:
    actual = F.col("_actual")
    return F.avg(F.abs(ratio(actual - guess, actual))) * 100.0


def history_and_forecast(
    series: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """History and forecast on one time axis, told apart by ``kind``."""
    past = series.withColumn("kind", F.lit("actual"))
    ahead = forecast.withColumn("kind", F.lit("forecast"))
    columns = [*keys, "period", "kind", "revenue", "forecast", "lower_80", "upper_80"]
    return past.unionByName(ahead, allowMissingColumns=True).select(*columns)


def weakest_month(indices: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The calendar month with the lowest index; the earlier one on a tie."""
    lowest = F.min(F.struct("seasonal", "month"))
    return (
        indices.groupBy(*keys)
        .agg(lowest.alias("_low"))
        .select(*keys, F.col("_low.month").alias("month"), F.col("_low.seasonal").alias("seasonal"))
    )


def run(
    detail: DataFrame, horizon: int = r.HORIZON_MONTHS, keys: Sequence[str] = ()
) -> ForecastRun:
    """Aggregate the lines once into a written series, then do everything from that."""
    series = materialize(monthly_series(detail, keys), "series")
    return ForecastRun(
        series,
        fit_predict(series, horizon, keys),
        seasonal_indices(series, keys),
        backtest(series, keys=keys),
    )
