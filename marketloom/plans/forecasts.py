"""Forecasts. The index model is checked by SQL that solves its least squares, the others by rows and by tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import evaluation, forecast, marts, series
from marketloom.plans.catalog import add, rounded


def _monthly(t):
    return marts.monthly_sales(t.sales)


def _summary(t):
    return marts.monthly_summary(t.sales)


def _daily(t):
    return marts.daily_summary(t.sales)


def _recursive(t):
    return forecast.forecast_lr_recursive(_summary(t))


def _seasonal(t):
    return forecast.forecast_seasonal(_daily(t))


add("forecast_lr_lags", lambda t: forecast.forecast_lr_lags(_summary(t)))
add(
    "forecast_lr_index",
    lambda t: rounded(forecast.forecast_lr_index(_monthly(t)), 1, "PredictedSales"),
    "SELECT Year, Month, ActualSales, ROUND(PredictedSales, 1) AS PredictedSales, Type FROM index_fit",
)
add("forecast_lr_recursive", _recursive)
add("forecast_seasonal", _seasonal)
add(
    "forecast_per_group",
    lambda t: forecast.forecast_per_group(
        t.sales.groupBy("Country", F.to_date("InvoiceDate").alias("Date")).agg(
            F.sum("TotalAmount").alias("Revenue")
        ),
        "Country",
    ),
)
add("monthly_from_daily", lambda t: series.monthly_from_daily(_seasonal(t), t.sales))
add("monthly_trend", lambda t: forecast.monthly_trend(_seasonal(t)))
add("confidence_width", lambda t: forecast.confidence_width(_seasonal(t)))
add(
    "confidence_width_monthly",
    lambda t: series.monthly_from_daily(_seasonal(t))
    .where(F.col("Type") == "Forecast")
    .select("YearMonth", (F.col("Upper_Bound") - F.col("Lower_Bound")).alias("Confidence_Interval")),
)
add(
    "union_actual_forecast",
    lambda t: forecast.dashboard_series(_monthly(t), 12).withColumn(
        "sales", F.when(F.col("type") == "Forecast", F.round("sales", 1)).otherwise(F.col("sales"))
    ),
    """SELECT printf('%d-%02d', Year, Month) AS date, CAST(MonthlySales AS DOUBLE) AS sales, 'Actual' AS type
       FROM (SELECT * FROM months ORDER BY Year DESC, Month DESC LIMIT 12)
       UNION ALL SELECT printf('%d-%02d', Year, Month), ROUND(PredictedSales, 1), 'Forecast'
       FROM index_fit WHERE Type = 'Forecast'""",
)
add("forecast_kpis", lambda t: evaluation.forecast_kpis(_recursive(t)))
add(
    "eval_rmse_r2",
    lambda t: evaluation.rmse_r2(
        forecast.forecast_lr_lags(_summary(t)), "actual_revenue", "forecasted_revenue"
    ),
)
add(
    "eval_rmse_r2_index",
    lambda t: rounded(
        evaluation.rmse_r2(
            forecast.forecast_lr_index(_monthly(t)).where(F.col("Type") == "Historical"), "ActualSales", "PredictedSales"
        ),
        3,
        "value",
    ),
    """SELECT metric, ROUND(value, 3) AS value
       FROM (SELECT SQRT(AVG((ActualSales - PredictedSales) ** 2)) AS rmse, AVG(ABS(ActualSales - PredictedSales)) AS mae,
                    1 - AVG((ActualSales - PredictedSales) ** 2) / VAR_POP(ActualSales) AS r2
             FROM index_fit WHERE Type = 'Historical') UNPIVOT (value FOR metric IN (rmse, r2, mae))""",
)
add(
    "eval_rmse_r2_recursive",
    lambda t: evaluation.rmse_r2(
        _recursive(t).where(F.col("Type") == "Historical"), "Revenue", "Predicted_Revenue"
    ),
)
add(
    "eval_forecast_errors",
    lambda t: evaluation.mape_rmse_mae(_recursive(t), "Revenue", "Predicted_Revenue"),
)
