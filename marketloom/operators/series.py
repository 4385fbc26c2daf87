"""Monthly and daily series.

Ordered windows without a partition appear only here, over series that hold one row per month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.columns import ratio

MONTH_ORDER = ["year", "month"]


def add_lags(monthly: DataFrame, lags: dict[str, tuple[str, int]], order: Sequence[str] = MONTH_ORDER):
    """New columns from earlier rows: name -> (column, rows back)."""
    window = W.orderBy(*order)
    return monthly.withColumns(
        {name: F.lag(column, back).over(window) for name, (column, back) in lags.items()}
    )


def moving_avg(
    monthly: DataFrame,
    column: str,
    name: str,
    lo: int = -2,
    hi: int = 0,
    full: bool = False,
    order: Sequence[str] = MONTH_ORDER,
) -> DataFrame:
    """Mean over a frame of rows; ``full`` keeps it NULL until the frame has all its rows."""
    frame = W.orderBy(*order).rowsBetween(lo, hi)
    # Summed as money first, so the mean does not depend on how the frame slides.
    mean = ratio(F.sum(column).over(frame), F.count(column).over(frame))
    if full:
        mean = F.when(F.count(column).over(frame) == hi - lo + 1, mean)
    return monthly.withColumn(name, mean)


def month_number(year: Column | str = "Year", month: Column | str = "Month", base: int = 2010) -> Column:
    """Months since the December before the base year."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return (year - base) * 12 + month


def with_position(monthly: DataFrame, name: str = "Month_Index", order: Sequence[str] = MONTH_ORDER):
    """0-based place in the series."""
    return monthly.withColumn(name, F.row_number().over(W.orderBy(*order)) - 1)


def last_months(monthly: DataFrame, n: int = 6, order: Sequence[str] = MONTH_ORDER) -> DataFrame:
    return monthly.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def last_row(monthly: DataFrame, order: Sequence[str] = MONTH_ORDER) -> DataFrame:
    """The newest row."""
    newest = F.max_by(F.struct("*"), F.struct(*order))
    return monthly.agg(newest.alias("_row")).select("_row.*")


def trend_slope(monthly: DataFrame, value: str, last: int = 6, order: Sequence[str] = MONTH_ORDER):
    """Least-squares slope per month over the last months."""
    tail = last_months(with_position(monthly, "_x", order), last, order)
    return tail.agg(
        F.regr_slope(F.col(value).cast("double"), F.col("_x").cast("double")).alias("slope")
    )


def month_growth(monthly: DataFrame, value: str, last: int = 6, order: Sequence[str] = MONTH_ORDER):
    """Mean change between neighbouring months over their mean, in percent."""
    tail = last_months(monthly, last, order)
    steps = tail.select(
        F.col(value).alias("_v"), (F.col(value) - F.lag(value).over(W.orderBy(*order))).alias("_step")
    )
    mean_step = ratio(F.sum("_step"), F.count("_step"))
    mean_value = ratio(F.sum("_v"), F.count("_v"))
    return steps.agg((F.try_divide(mean_step, mean_value) * 100).alias("growth_pct"))


def future_months(monthly: DataFrame, horizon: int = 3, order: Sequence[str] = ("Year", "Month")):
    """The calendar months after the newest one, as rows."""
    year, month = order
    newest = monthly.agg(F.max(F.make_date(F.col(year), F.col(month), F.lit(1))).alias("_newest"))
    dates = F.sequence(
        F.add_months("_newest", 1), F.add_months("_newest", horizon), F.expr("INTERVAL 1 MONTH")
    )
    return (
        newest.where(F.col("_newest").isNotNull())
        .select(F.explode(dates).alias("_date"))
        .select(F.year("_date").alias(year), F.month("_date").alias(month))
    )


def future_days(daily: DataFrame, horizon: int = 90, column: str = "Date") -> DataFrame:
    """The days after the newest one, as rows."""
    newest = daily.agg(F.max(column).alias("_newest"))
    dates = F.sequence(
        F.date_add("_newest", 1), F.date_add("_newest", horizon), F.expr("INTERVAL 1 DAY")
    )
    return newest.where(F.col("_newest").isNotNull()).select(F.explode(dates).alias(column))


def monthly_from_daily(forecast: DataFrame, sales: DataFrame | None = None) -> DataFrame:
    """Actual, fitted and bound columns of a daily forecast by month and type.

    With the sales lines, historical months also get orders, items and distinct customers, the last
    counted from the lines and not from daily counts.
    """
    month = F.date_format("Date", "yyyy-MM").alias("YearMonth")
    rolled = forecast.groupBy(month, "Type").agg(
        F.sum("Revenue").alias("Revenue"),
        F.sum("Predicted_Revenue").alias("Predicted_Revenue"),
        F.sum("Lower_Bound").alias("Lower_Bound"),
        F.sum("Upper_Bound").alias("Upper_Bound"),
    )
    if sales is None:
        return rolled
    counts = sales.groupBy(F.date_format("InvoiceDate", "yyyy-MM").alias("_month")).agg(
        F.count(F.lit(1)).alias("Orders"),
        F.count_distinct("CustomerID").alias("Customers"),
        F.sum("Quantity").alias("ItemsSold"),
    )
    on = (F.col("YearMonth") == F.col("_month")) & (F.col("Type") == "Historical")
    return rolled.join(counts, on, "left").drop("_month")
