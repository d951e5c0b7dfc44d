"""Daily revenue forecast: linear trend with weekday and month effects.

The series has one row per calendar day, so it is small whatever the data's size; the join and sums that make
it are the distributed work. The model is Spark ML's least squares.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from marketloom.operators.anomaly import daily_net
from marketloom.operators.ranking import written
from marketloom.params import DEFAULTS, Params
from marketloom.shop import Shop

# The levels come from the calendar, not from the data, so any future window has the same columns.
WEEKDAYS = tuple(range(1, 7))
MONTHS = tuple(range(2, 13))
FEATURES = ("day_index", *(f"dow_{d}" for d in WEEKDAYS), *(f"month_{m}" for m in MONTHS))


def revenue_calendar(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    return daily_net(shop)


def calendar_columns(days: DataFrame, first_day: Column) -> DataFrame:
    return days.withColumns({
        "day_index": F.datediff("order_day", first_day),
        "day_of_week": F.weekday("order_day"),
        "month": F.month("order_day"),
    })


def one_hot(days: DataFrame) -> DataFrame:
    """0/1 columns for weekday and month, Monday and January being the base."""
    return days.withColumns({
        **{f"dow_{d}": (F.col("day_of_week") == d).cast("int") for d in WEEKDAYS},
        **{f"month_{m}": (F.col("month") == m).cast("int") for m in MONTHS},
    })


def _with_features(days: DataFrame, first_day: Column) -> DataFrame:
    return one_hot(calendar_columns(days, first_day))


def feature_table(shop: Shop, params: Params = DEFAULTS) -> DataFrame:
    series = written(daily_net(shop), "daily-revenue")
    return _with_features(series, series.agg(F.min("order_day")).scalar())


def _fit(rows: DataFrame) -> LinearRegressionModel:
    ready = _assembled(rows).withColumn("label", F.col("revenue").cast("double"))
    return LinearRegression(solver="normal", regParam=0.0, labelCol="label").fit(ready)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


@dataclass(frozen=True)
class RevenueForecast:
    """Both fits of one series: on all but the last days for the errors, on everything for the future."""

    days: DataFrame
    backtest: DataFrame
    future: DataFrame


def revenue_forecast(shop: Shop, params: Params = DEFAULTS) -> RevenueForecast:
    series = written(daily_net(shop), "daily-revenue")
    first, last = series.agg(F.min("order_day")).scalar(), series.agg(F.max("order_day")).scalar()
    days = written(_with_features(series, first), "forecast-days")
    split = days.agg(F.max("day_index") + 1 - params.holdout_days).scalar()
    held_out = _fit(days.filter(F.col("day_index") < split)).transform(
        _assembled(days.filter(F.col("day_index") >= split))
    )
    backtest = held_out.select("order_day", F.col("revenue").cast("double").alias("revenue"), "prediction")
    ahead = series.agg(
        F.explode(F.sequence(F.date_add(F.max("order_day"), 1), F.date_add(F.max("order_day"), params.horizon_days)))
        .alias("order_day")
    )
    predicted = _fit(days).transform(_assembled(_with_features(ahead, first)))
    value = F.greatest(F.col("prediction"), F.lit(0.0))
    band = params.band_sigma * error_deviation(backtest).scalar()
    future = predicted.select(
        "order_day",
        value.alias("forecast_revenue"),
        F.greatest(value - band, F.lit(0.0)).alias("lower_bound"),
        (value + band).alias("upper_bound"),
        F.datediff("order_day", last).alias("days_ahead"),
    )
    return RevenueForecast(days, backtest, future)


def forecast_errors(backtest: DataFrame) -> DataFrame:
    """Mean absolute error, and relative error over the days with revenue."""
    miss = F.abs(F.col("revenue") - F.col("prediction"))
    return backtest.agg(
        F.avg(miss).alias("mae"),
        (F.avg(F.when(F.col("revenue") != 0, miss / F.abs("revenue"))) * 100).alias("mape_pct"),
    )


def error_deviation(backtest: DataFrame) -> DataFrame:
    """Population deviation of the hold-out residuals."""
    return backtest.agg(F.stddev_pop(F.col("revenue") - F.col("prediction")).alias("residual_sigma"))


def forecast_totals(future: DataFrame, spans: tuple[int, ...] = (30, 60, 90)) -> DataFrame:
    """Totals of the next days; null for a span that the forecast does not reach."""
    return future.agg(*[
        F.when(F.max("days_ahead") >= n, F.sum(F.when(F.col("days_ahead") <= n, F.col("forecast_revenue"))))
        .alias(f"next_{n}_days") for n in spans
    ])
