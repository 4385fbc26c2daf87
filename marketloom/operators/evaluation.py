"""Model quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import percent_change, ratio


def mape_rmse_mae(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Percentage, squared and absolute error and 100 - MAPE over two columns."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = F.abs(a - p)
    mape = F.avg(F.try_divide(error, a)) * 100
    return df.where(a.isNotNull() & p.isNotNull()).agg(
        mape.alias("mape"),
        F.sqrt(F.avg(F.pow(a - p, F.lit(2)))).alias("rmse"),
        F.avg(error).alias("mae"),
        (100 - mape).alias("model_accuracy"),
    )


def binary_metric(
    predictions: DataFrame, label: str, prediction: str, name: str, raw: str = "rawPrediction"
) -> float:
    """Area under ROC (``auc``), ``accuracy`` or weighted ``precision``."""
    if name == "auc":
        return BinaryClassificationEvaluator(
            labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC"
        ).evaluate(predictions)
    metric = {"accuracy": "accuracy", "precision": "weightedPrecision"}[name]
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName=metric
    ).evaluate(predictions)


def binary_metrics(
    predictions: DataFrame,
    label: str,
    prediction: str,
    raw: str = "rawPrediction",
    names: Sequence[str] = ("auc", "accuracy", "precision"),
) -> DataFrame:
    """One row per metric, and one evaluation for each that is asked for."""
    rows = [(name, float(binary_metric(predictions, label, prediction, name, raw))) for name in names]
    return predictions.sparkSession.createDataFrame(rows, "metric STRING, value DOUBLE")


def class_report(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = predictions.groupBy(
        F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("guess")
    ).agg(F.count(F.lit(1)).alias("rows"))
    classes = cells.select(
        F.explode(F.array_distinct(F.array("actual", "guess"))).alias("class"), "actual", "guess", "rows"
    )
    mine, said = F.col("actual") == F.col("class"), F.col("guess") == F.col("class")

    def total(condition):
        return F.sum(F.when(condition, F.col("rows")).otherwise(0))

    hits = total(mine & said)
    precision = F.coalesce(ratio(hits, total(said)), F.lit(0.0))
    recall = F.coalesce(ratio(hits, total(mine)), F.lit(0.0))
    return classes.groupBy("class").agg(
        precision.alias("precision"),
        recall.alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
        total(mine).alias("support"),
    )


def rmse_r2(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    rows = [
        (
            name,
            float(
                RegressionEvaluator(
                    labelCol=label, predictionCol=prediction, metricName=name
                ).evaluate(predictions)
            ),
        )
        for name in ("rmse", "r2", "mae")
    ]
    return predictions.sparkSession.createDataFrame(rows, "metric STRING, value DOUBLE")


def forecast_kpis(forecast: DataFrame, month: str = "YearMonth") -> DataFrame:
    """Last actual, next forecast and its growth, the forecast's sum, and mean forecast against history."""
    past, future = F.col("Type") == "Historical", F.col("Type") == "Forecast"
    revenue, predicted = F.col("Revenue").cast("double"), F.col("Predicted_Revenue").cast("double")
    return forecast.agg(
        F.max_by(F.when(past, revenue), F.when(past, F.col(month))).alias("last_actual"),
        F.min_by(F.when(future, predicted), F.when(future, F.col(month))).alias("next_forecast"),
        F.sum(F.when(future, predicted)).alias("total_forecast"),
        F.avg(F.when(past, revenue)).alias("avg_historical"),
        F.avg(F.when(future, predicted)).alias("avg_forecast"),
    ).withColumns(
        {
            "growth_pct": percent_change("last_actual", "next_forecast"),
            "trend_pct": percent_change("avg_historical", "avg_forecast"),
        }
    )
