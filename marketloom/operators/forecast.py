"""Revenue forecasts: three monthly regressions and a seasonal daily model."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import month_start, year_month_label
from marketloom.functions.keys import train_test_split
from marketloom.operators.series import (
    add_lags,
    future_days,
    future_months,
    last_months,
    month_number,
    moving_avg,
    trend_slope,
    with_position,
)
from marketloom.session import stored
from marketloom.sources.schemas import LAG_FORECAST_DDL

# ---------------------------------------------------------------- lag model

LAGS = {
    "revenue_lag1": ("total_revenue", 1),
    "revenue_lag2": ("total_revenue", 2),
    "revenue_lag3": ("total_revenue", 3),
    "orders_lag1": ("total_orders", 1),
    "customers_lag1": ("unique_customers", 1),
}
LAG_FEATURES = ["month", *LAGS, "moving_avg_3m"]


def revenue_lags(summary: DataFrame) -> DataFrame:
    """Lags of revenue, orders and customers, and the mean of the three months before."""
    return moving_avg(add_lags(summary, LAGS), "total_revenue", "moving_avg_3m", -3, -1)


def _assembled(df: DataFrame, inputs: list[str], label: str | None = None) -> DataFrame:
    doubles = {c: F.col(c).cast("double") for c in inputs}
    if label:
        doubles["label"] = F.col(label).cast("double")
    numbers = df.select("*", *[v.alias(f"_{n}") for n, v in doubles.items()])
    out = VectorAssembler(inputCols=[f"_{c}" for c in inputs], outputCol="features").transform(numbers)
    return out.withColumnRenamed("_label", "label").drop(*[f"_{c}" for c in inputs])


def forecast_lr_lags(summary: DataFrame, seed: int = 42) -> DataFrame:
    """Elastic net on lag features with ten percent bounds; empty when there are three rows or fewer."""
    rows = revenue_lags(stored(summary)).where(F.col("revenue_lag3").isNotNull())
    data = _assembled(rows, LAG_FEATURES, "total_revenue").select("year", "month", "features", "label")
    if data.limit(4).count() <= 3:
        return summary.sparkSession.createDataFrame([], LAG_FORECAST_DDL)
    train, _ = train_test_split(data, ["year", "month"], 0.8, seed)
    model = LinearRegression(maxIter=100, regParam=0.1, elasticNetParam=0.8).fit(train)
    guess = F.col("prediction")
    return model.transform(data).select(
        "year",
        "month",
        F.col("label").alias("actual_revenue"),
        guess.alias("forecasted_revenue"),
        (guess * 0.9).alias("forecast_lower"),
        (guess * 1.1).alias("forecast_upper"),
        (100 * (1 - F.try_divide(F.abs(F.col("label") - guess), F.col("label")))).alias("accuracy"),
    )


# -------------------------------------------------------------- index model


def forecast_lr_index(monthly: DataFrame, horizon: int = 3, train_share: float = 0.8) -> DataFrame:
    """Regression on month number, month and the mean of the two months before.

    Trained on the first part of the months. Every future month uses the last actual sales as the mean.
    """
    inputs = ["MonthIndex", "Month", "AvgPrevSales"]
    order = ["Year", "Month"]
    monthly = stored(monthly)
    history = moving_avg(monthly, "MonthlySales", "AvgPrevSales", -2, -1, order=order).select(
        "Year",
        "Month",
        F.col("MonthlySales").cast("double").alias("MonthlySales"),
        month_number().alias("MonthIndex"),
        F.coalesce("AvgPrevSales", F.lit(0.0)).alias("AvgPrevSales"),
    )
    months = history.agg(F.count(F.lit(1))).scalar()
    placed = with_position(history, "_place", order)
    first = F.col("_place") < F.greatest(F.ceil(months * F.lit(train_share)), F.lit(1))
    train = placed.where(first).drop("_place")
    model = LinearRegression(predictionCol="PredictedSales").fit(_assembled(train, inputs, "MonthlySales"))

    newest = history.agg(F.max_by("MonthlySales", "MonthIndex")).scalar()
    future = future_months(history, horizon).select(
        "Year", "Month", month_number().alias("MonthIndex"), newest.alias("AvgPrevSales")
    )
    past = model.transform(_assembled(history, inputs)).select(
        "Year",
        "Month",
        F.col("MonthlySales").alias("ActualSales"),
        "PredictedSales",
        F.lit("Historical").alias("Type"),
    )
    ahead = model.transform(_assembled(future, inputs)).select(
        "Year",
        "Month",
        F.lit(None).cast("double").alias("ActualSales"),
        "PredictedSales",
        F.lit("Forecast").alias("Type"),
    )
    return past.unionByName(ahead)


# ---------------------------------------------------------- recursive model


def _linear(model: LinearRegressionModel, values: list[Column]) -> Column:
    out = F.lit(float(model.intercept))
    for weight, value in zip(model.coefficients.toArray(), values, strict=True):
        out = out + F.lit(float(weight)) * value
    return out


def forecast_lr_recursive(summary: DataFrame, horizon: int = 3, damp: float = 0.7) -> DataFrame:
    """Regression on position, two lags and the moving mean; each step feeds on the steps before.

    The moving mean of a step is over its newest actual and predicted months: all three actuals for the
    first step, from then on the last actuals that are left plus the predictions, three values at most.
    A damped share of the recent slope is added and results stay at or above zero. Needs five rows.
    """
    inputs = ["Month_Index", "Revenue_Lag1", "Revenue_Lag2", "Moving_Avg_3M"]
    base = stored(summary.select("year", "month", F.col("total_revenue").alias("Revenue")))
    rows = with_position(base)
    rows = add_lags(rows, {f"Revenue_Lag{i}": ("Revenue", i) for i in (1, 2, 3)})
    rows = moving_avg(rows, "Revenue", "Moving_Avg_3M", -3, -1)
    data = _assembled(rows.where(F.col("Revenue_Lag3").isNotNull()), inputs, "Revenue")
    label = year_month_label("year", "month").alias("YearMonth")
    schema = "YearMonth STRING, Revenue DOUBLE, Predicted_Revenue DOUBLE, Type STRING"
    if data.limit(5).count() < 5:
        return summary.sparkSession.createDataFrame([], schema)
    model = LinearRegression().fit(data)
    past = model.transform(data).select(
        label,
        F.col("label").alias("Revenue"),
        F.col("prediction").alias("Predicted_Revenue"),
        F.lit("Historical").alias("Type"),
    )

    # One row: the last three actuals, newest first, the last position and date, and the slope.
    tail = last_months(rows, 3).agg(
        F.reverse(
            F.array_sort(
                F.collect_list(F.struct("Month_Index", F.col("Revenue").cast("double").alias("Revenue")))
            )
        ).alias("t"),
        F.max("Month_Index").cast("double").alias("last_index"),
        F.max(month_start("year", "month")).alias("last_date"),
    )
    slope = trend_slope(base, "Revenue").select("slope").scalar()
    actuals = [F.col("t")[i]["Revenue"] for i in range(3)]
    state = tail.select("last_index", "last_date", *[a.alias(f"a{i}") for i, a in enumerate(actuals)])
    known = [F.col(f"a{i}") for i in range(3)]
    steps: list[str] = []
    for i in range(1, horizon + 1):
        predicted = [F.col(s) for s in reversed(steps)]
        lag1, lag2 = (predicted + known)[:2]
        if i == 1:
            recent = known
        else:
            recent = (predicted + known[: max(3 - i, 1)])[:3]
        mean = sum(recent[1:], recent[0]) / len(recent)
        value = _linear(model, [F.col("last_index") + i, lag1, lag2, mean]) + slope * (damp * i)
        state = state.withColumn(f"f{i}", F.greatest(value, F.lit(0.0)))
        steps.append(f"f{i}")
    ahead = state.select("last_date", F.posexplode(F.array(*steps)).alias("_i", "Predicted_Revenue")).select(
        F.date_format(F.add_months("last_date", F.col("_i") + 1), "yyyy-MM").alias("YearMonth"),
        F.lit(None).cast("double").alias("Revenue"),
        "Predicted_Revenue",
        F.lit("Forecast").alias("Type"),
    )
    return past.unionByName(ahead)


# ----------------------------------------------------------- seasonal model

# Period in days and number of harmonics of each season.
SEASONS = {"weekly": (7.0, 3), "monthly": (30.44, 5), "yearly": (365.25, 10)}
CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8


def _width(level: float) -> float:
    """Half width of a two-sided normal interval, in standard deviations."""
    return NormalDist().inv_cdf(0.5 + level / 2)


def _knots() -> list[float]:
    """Places in 0..1 where the trend may bend, the start left out."""
    return [CHANGEPOINT_RANGE * (i + 1) / (CHANGEPOINTS + 1) for i in range(CHANGEPOINTS)]


def _bend_variance(bends: np.ndarray, ahead):
    """Variance of the trend some way ahead (in spans of the history), from bends still to come.

    They are expected as often and as strong as those of the history: ``CHANGEPOINTS`` in the first
    ``CHANGEPOINT_RANGE`` of the span, with two-sided exponential sizes of the same mean. A bend that comes u
    ahead adds its size times (ahead - u).
    """
    rate = CHANGEPOINTS / CHANGEPOINT_RANGE
    return ahead * ahead * ahead * (rate * 2.0 * float(np.mean(np.abs(bends))) ** 2 / 3.0)


def _season_columns(day: Column) -> dict[str, Column]:
    out = {}
    for name, (period, order) in SEASONS.items():
        for j in range(1, order + 1):
            angle = day * (2.0 * math.pi * j / period)
            out[f"{name}_sin{j}"] = F.sin(angle)
            out[f"{name}_cos{j}"] = F.cos(angle)
    return out


def _trend_columns(t: Column) -> dict[str, Column]:
    out = {"trend": t}
    for i, knot in enumerate(_knots()):
        out[f"bend{i}"] = F.greatest(t - knot, F.lit(0.0))
    return out


@dataclass(frozen=True)
class SeasonalModel:
    """Coefficients of the additive model, the span of days it was fitted on, and what the interval needs."""

    linear: LinearRegressionModel
    names: list[str]
    first: dt.date
    last: dt.date
    width: float
    noise: float

    def _columns(self) -> dict[str, Column]:
        return seasonal_columns(self.first, self.last)

    def yhat(self) -> Column:
        columns = self._columns()
        return _linear(self.linear, [columns[n] for n in self.names])

    def margin(self) -> Column:
        """Half of the interval: the residuals' spread, and for days ahead also the trend's."""
        weights = self.linear.coefficients.toArray()
        bends = np.array([w for n, w in zip(self.names, weights, strict=True) if n.startswith("bend")])
        days = float(max((self.last - self.first).days, 1))
        ahead = F.greatest(F.date_diff("Date", F.lit(self.last)) / F.lit(days), F.lit(0.0))
        return F.sqrt(F.lit(self.noise**2) + _bend_variance(bends, ahead)) * self.width

    def trend(self) -> Column:
        columns = self._columns()
        out = F.lit(float(self.linear.intercept))
        for name, weight in zip(self.names, self.linear.coefficients.toArray(), strict=True):
            if name == "trend" or name.startswith("bend"):
                out = out + F.lit(float(weight)) * columns[name]
        return out


def seasonal_columns(first: dt.date, last: dt.date) -> dict[str, Column]:
    """Trend and season columns of a ``Date``, relative to the span of the history."""
    days = max((last - first).days, 1)
    t = F.date_diff("Date", F.lit(first)) / F.lit(float(days))
    # Days since a fixed epoch, so a season has the same phase whatever the history.
    day = F.date_diff("Date", F.lit(dt.date(1970, 1, 1))).cast("double")
    return {**_trend_columns(t), **_season_columns(day)}


def fit_seasonal(daily: DataFrame, ridge: float = 0.01, level: float = 0.95) -> SeasonalModel:
    """Ridge regression of daily revenue on a bending trend and Fourier seasons."""
    span = daily.agg(F.min("Date").alias("first"), F.max("Date").alias("last")).first()
    columns = seasonal_columns(span["first"], span["last"])
    rows = daily.select(F.col("Revenue").cast("double").alias("Revenue"), *[
        c.alias(n) for n, c in columns.items()
    ])
    names = list(columns)
    data = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    linear = LinearRegression(labelCol="Revenue", regParam=ridge, elasticNetParam=0.0).fit(data)
    noise = float(linear.summary.rootMeanSquaredError)
    return SeasonalModel(linear, names, span["first"], span["last"], _width(level), noise)


def seasonal_rows(model: SeasonalModel, daily: DataFrame, horizon: int = 90) -> DataFrame:
    """Fitted history and forecast days with bounds, their width and the trend."""
    past = daily.select("Date", F.col("Revenue").cast("double").alias("Revenue")).withColumn(
        "Type", F.lit("Historical")
    )
    ahead = future_days(daily, horizon).select(
        "Date", F.lit(None).cast("double").alias("Revenue"), F.lit("Forecast").alias("Type")
    )
    fitted = past.unionByName(ahead).withColumns(
        {"Predicted_Revenue": model.yhat(), "Trend": model.trend(), "_margin": model.margin()}
    )
    return fitted.withColumns(
        {
            "Lower_Bound": F.col("Predicted_Revenue") - F.col("_margin"),
            "Upper_Bound": F.col("Predicted_Revenue") + F.col("_margin"),
            "Confidence_Interval": 2 * F.col("_margin"),
        }
    ).drop("_margin")


def forecast_seasonal(daily: DataFrame, horizon: int = 90, level: float = 0.95) -> DataFrame:
    daily = stored(daily)
    return seasonal_rows(fit_seasonal(daily, level=level), daily, horizon)


def monthly_trend(forecast: DataFrame) -> DataFrame:
    """Mean fitted trend per historical month."""
    return (
        forecast.where(F.col("Type") == "Historical")
        .groupBy(F.date_format("Date", "yyyy-MM").alias("YearMonth"))
        .agg(F.avg("Trend").alias("Trend"))
    )


def confidence_width(forecast: DataFrame) -> DataFrame:
    """Width of the interval per forecast day."""
    return forecast.where(F.col("Type") == "Forecast").select(
        "Date",
        F.col("Predicted_Revenue").alias("Revenue"),
        "Upper_Bound",
        "Lower_Bound",
        (F.col("Upper_Bound") - F.col("Lower_Bound")).alias("Confidence_Interval"),
    )


def _design(days: np.ndarray, first: float, last: float) -> np.ndarray:
    """The seasonal columns of day numbers, as in ``seasonal_columns``."""
    t = (days - first) / max(last - first, 1.0)
    parts = [t] + [np.maximum(t - knot, 0.0) for knot in _knots()]
    for period, order in SEASONS.values():
        for j in range(1, order + 1):
            angle = days * (2.0 * math.pi * j / period)
            parts += [np.sin(angle), np.cos(angle)]
    return np.column_stack(parts)


def forecast_per_group(
    daily: DataFrame, key: str, horizon: int = 90, ridge: float = 0.01, level: float = 0.95
) -> DataFrame:
    """The seasonal model for every series of (key, Date, Revenue).

    The input holds one row per key and day, so a group is as long as the calendar, however many sales
    a key has.
    """

    width = _width(level)

    def solve(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values("Date")
        days = (pd.to_datetime(series["Date"]) - pd.Timestamp("1970-01-01")).dt.days.to_numpy(float)
        y = series["Revenue"].to_numpy(float)
        ahead = days[-1] + np.arange(1, horizon + 1)
        x = _design(days, days[0], days[-1])
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale == 0] = 1.0
        z = (x - mean) / scale
        weights = np.linalg.solve(
            z.T @ z + ridge * len(y) * np.eye(z.shape[1]), z.T @ (y - y.mean())
        )
        residual = y - (y.mean() + z @ weights)
        bends = (weights / scale)[1 : 1 + CHANGEPOINTS]
        reach = (ahead - days[-1]) / max(days[-1] - days[0], 1.0)
        margin = width * np.sqrt(float(np.mean(residual**2)) + _bend_variance(bends, reach))
        future = y.mean() + ((_design(ahead, days[0], days[-1]) - mean) / scale) @ weights
        return pd.DataFrame(
            {
                key: series[key].iloc[0],
                "Date": (pd.Timestamp("1970-01-01") + pd.to_timedelta(ahead, unit="D")).date,
                "Revenue": future,
                "Upper_Bound": future + margin,
                "Lower_Bound": future - margin,
                "Confidence_Interval": 2 * margin,
            }
        )

    typed = daily.select(key, "Date", F.col("Revenue").cast("double").alias("Revenue"))
    kind = dict(typed.dtypes)[key]
    schema = (
        f"`{key}` {kind}, Date DATE, Revenue DOUBLE, Upper_Bound DOUBLE, Lower_Bound DOUBLE, "
        "Confidence_Interval DOUBLE"
    )
    return typed.groupBy(key).applyInPandas(solve, schema)


def dashboard_series(monthly: DataFrame, months: int = 12, horizon: int = 3) -> DataFrame:
    """The newest actual months and the months ahead under one date label."""
    monthly = stored(monthly)
    label = year_month_label("Year", "Month").alias("date")
    actual = last_months(monthly, months, ["Year", "Month"]).select(
        label, F.col("MonthlySales").cast("double").alias("sales"), F.lit("Actual").alias("type")
    )
    ahead = (
        forecast_lr_index(monthly, horizon)
        .where(F.col("Type") == "Forecast")
        .select(label, F.col("PredictedSales").alias("sales"), F.lit("Forecast").alias("type"))
    )
    return actual.unionByName(ahead)
