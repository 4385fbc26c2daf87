"""Outlying transactions by z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import at_least, position_in, ratio
from marketloom.operators.reports import top_n

MEASURES = {"qty": "Quantity", "price": "UnitPrice", "amount": "TotalAmount"}
SEVERITIES = ["Critical", "High", "Medium", "Low"]


def column_stats(sales: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of the three measures, one row."""
    out = []
    for name, column in MEASURES.items():
        value = F.col(column).cast("double")
        out += [
            ratio(F.sum(column), F.count(column)).alias(f"mean_{name}"),
            F.stddev_samp(value).alias(f"std_{name}"),
        ]
    return sales.where(F.col("TotalAmount") > 0).agg(*out)


def with_z_scores(sales: DataFrame) -> DataFrame:
    """Absolute z-scores against the statistics of all lines; 0 when a measure does not vary."""
    stats = column_stats(sales).select(F.struct("*")).scalar()

    def z(name: str, column: str) -> Column:
        distance = F.col(column).cast("double") - F.col("_stats")[f"mean_{name}"]
        return F.coalesce(F.abs(F.try_divide(distance, F.col("_stats")[f"std_{name}"])), F.lit(0.0))

    return (
        sales.where(F.col("TotalAmount") > 0)
        .withColumn("_stats", stats)
        .withColumns({f"{name}_zscore": z(name, column) for name, column in MEASURES.items()})
        .drop("_stats")
    )


def anomalies(
    sales: DataFrame, threshold: float = 3.0, severity: Sequence[float] = (5, 4, 3)
) -> DataFrame:
    """Every line with its flag, the first measure over the threshold, mean z and severity."""
    qty, price, amount = (F.col(f"{name}_zscore") > threshold for name in MEASURES)
    kind = (
        F.when(qty, "High Quantity")
        .when(price, "High Price")
        .when(amount, "High Amount")
        .otherwise("Normal")
    )
    score = (F.col("qty_zscore") + F.col("price_zscore") + F.col("amount_zscore")) / 3.0
    return with_z_scores(sales).select(
        "InvoiceNo",
        "CustomerID",
        "StockCode",
        "Description",
        "Quantity",
        "UnitPrice",
        "TotalAmount",
        "InvoiceDate",
        "Country",
        (qty | price | amount).cast("int").alias("is_anomaly"),
        kind.alias("anomaly_type"),
        score.alias("anomaly_score"),
        at_least(score, severity, SEVERITIES[:3], SEVERITIES[3]).alias("severity"),
        "qty_zscore",
        "price_zscore",
        "amount_zscore",
    )


def anomaly_rate(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies"),
        F.coalesce(ratio(F.sum("is_anomaly"), F.count(F.lit(1))) * 100, F.lit(0.0)).alias("anomaly_rate"),
    )


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    """Lines, mean score and amount per severity, worst first."""
    return (
        flagged.groupBy("severity")
        .agg(
            F.count(F.lit(1)).alias("anomaly_count"),
            F.avg("anomaly_score").alias("avg_score"),
            F.sum("TotalAmount").alias("total_amount"),
        )
        .orderBy(position_in("severity", SEVERITIES[:3]))
    )


def with_severity(flagged: DataFrame, wanted: Sequence[str] = ("Critical", "High")) -> DataFrame:
    return flagged.where(F.col("severity").isin(list(wanted)))


def top_anomalies(flagged: DataFrame, wanted: Sequence[str] = ("Critical",), n: int = 10) -> DataFrame:
    ties = ["InvoiceNo", "StockCode", "Quantity", "TotalAmount"]
    return top_n(with_severity(flagged, wanted), "anomaly_score", ties, n)
