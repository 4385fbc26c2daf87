"""Recency, frequency and monetary scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import at_least, at_most, calendar_days, elapsed_days, ratio
from marketloom.functions.quantiles import column_quantiles, exact_quantiles
from marketloom.operators.reports import top_n
from marketloom.session import stored

# Lowest score of each segment in tenths, best segment first.
SEGMENT_FLOORS = [45, 40, 35, 30, 25, 20, 15]
SEGMENT_NAMES = [
    "Champions",
    "Loyal Customers",
    "Potential Loyalists",
    "Recent Customers",
    "Promising",
    "Needs Attention",
    "At Risk",
]
LOWEST_SEGMENT = "Lost"

METRICS = ["Recency", "Frequency", "Monetary"]
PROBS = [0.2, 0.4, 0.6, 0.8]


def score_tenths(weights: Sequence[int] = (3, 3, 4)) -> Column:
    """Weighted score times ten. Whole numbers, so a score on a segment border stays on it."""
    r, f, m = weights
    return F.col("R_Score") * r + F.col("F_Score") * f + F.col("M_Score") * m


def segment(tenths: Column) -> Column:
    return at_least(tenths, SEGMENT_FLOORS, SEGMENT_NAMES, LOWEST_SEGMENT)


def churn_risk(r_score: str = "R_Score") -> Column:
    return at_most(r_score, [2, 3], ["High", "Medium"], "Low")


def _finish(scored: DataFrame, weights: Sequence[int]) -> DataFrame:
    tenths = score_tenths(weights)
    return scored.withColumns(
        {
            "RFM_Score": tenths / F.lit(10.0),
            "RFM_Segment": segment(tenths),
            "Churn_Risk": churn_risk(),
        }
    )


def rfm_fixed(
    sales: DataFrame,
    r: Sequence[int] = (30, 60, 90, 180),
    f: Sequence[int] = (50, 20, 10, 5),
    m: Sequence[int] = (5000, 2000, 1000, 500),
    weights: Sequence[int] = (3, 3, 4),
) -> DataFrame:
    """Fixed thresholds; frequency counts lines, recency counts calendar days."""
    lines = sales.where(
        F.col("CustomerID").isNotNull() & (F.col("TotalAmount") > 0) & F.col("InvoiceDate").isNotNull()
    )
    # The newest sale is the newest of the customers' last ones, so the lines are read once.
    grouped = stored(
        lines.groupBy("CustomerID").agg(
            F.max("InvoiceDate").alias("_last"),
            F.count("InvoiceNo").alias("Frequency"),
            F.sum("TotalAmount").alias("Monetary"),
        )
    )
    newest = grouped.agg(F.max("_last")).scalar()
    metrics = grouped.select(
        "CustomerID", calendar_days("_last", newest).alias("Recency"), "Frequency", "Monetary"
    )
    scored = metrics.withColumns(
        {
            "R_Score": at_most("Recency", r, [5, 4, 3, 2], 1),
            "F_Score": at_least("Frequency", f, [5, 4, 3, 2], 1),
            "M_Score": at_least("Monetary", m, [5, 4, 3, 2], 1),
        }
    )
    return _finish(scored, weights)


def rfm_metrics(customer_sales: DataFrame) -> DataFrame:
    """Days to the newest sale plus one day, distinct invoices and spend per customer."""
    # Invoices first: counting them distinct and the newest sale then need no second look at the lines.
    invoices = customer_sales.groupBy("CustomerID", "InvoiceNo").agg(
        F.max("InvoiceDate").alias("_last"), F.sum("TotalAmount").alias("_total")
    )
    grouped = stored(
        invoices.groupBy("CustomerID").agg(
            F.max("_last").alias("_last"),
            F.count("InvoiceNo").alias("Frequency"),
            F.sum("_total").cast("decimal(28,2)").alias("Monetary"),
        )
    )
    reference = grouped.agg(F.max("_last") + F.expr("INTERVAL 1 DAY")).scalar()
    return grouped.select(
        "CustomerID", elapsed_days("_last", reference).alias("Recency"), "Frequency", "Monetary"
    )


def rfm_quintiles(metrics: DataFrame) -> DataFrame:
    """The 20, 40, 60 and 80 percent points of each metric, one row per metric that has values."""
    points = column_quantiles(metrics, METRICS, PROBS)
    each = F.array(*[F.struct(F.lit(m).alias("Metric"), points[m].alias("q")) for m in METRICS])
    rows = metrics.sparkSession.range(1).select(F.explode(each).alias("p"))
    named = [F.col("p.q")[i].alias(f"q{int(p * 100)}") for i, p in enumerate(PROBS)]
    return rows.where(F.col("p.q")[0].isNotNull()).select("p.Metric", *named)


def rfm_quintile(customer_sales: DataFrame, weights: Sequence[int] = (3, 3, 4)) -> DataFrame:
    """Scores by the quintiles of the customers themselves; frequency counts invoices."""
    metrics = stored(rfm_metrics(customer_sales))
    points = column_quantiles(metrics, METRICS, PROBS)

    def ladder(metric: str, hits) -> Column:
        out = None
        value = F.col(metric).cast("double")
        for place, score in hits:
            edge = points[metric][place]
            hit = value <= edge if metric == "Recency" else value >= edge
            out = F.when(hit, score) if out is None else out.when(hit, score)
        return out.otherwise(1)

    rising = list(zip(range(len(PROBS)), [5, 4, 3, 2], strict=True))
    falling = list(zip(reversed(range(len(PROBS))), [5, 4, 3, 2], strict=True))
    scored = metrics.withColumns(
        {
            "R_Score": ladder("Recency", rising),
            "F_Score": ladder("Frequency", falling),
            "M_Score": ladder("Monetary", falling),
        }
    )
    return _finish(scored, weights)


def segment_metrics(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("RFM_Segment").agg(
        F.count("CustomerID").alias("Customers"),
        F.round(ratio(F.sum("Recency"), F.count("Recency")), 2).alias("AvgRecency"),
        F.round(ratio(F.sum("Frequency"), F.count("Frequency")), 2).alias("AvgFrequency"),
        F.round(ratio(F.sum("Monetary"), F.count("Monetary")), 2).alias("AvgMonetary"),
        F.round(ratio(F.sum(score_tenths()), F.count("RFM_Score") * 10), 2).alias("AvgScore"),
    )


def segment_by_risk(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("RFM_Segment", "Churn_Risk").agg(
        F.count(F.lit(1)).alias("customer_count"),
        ratio(F.sum("Recency"), F.count("Recency")).alias("avg_recency_days"),
        ratio(F.sum("Frequency"), F.count("Frequency")).alias("avg_frequency"),
        ratio(F.sum("Monetary"), F.count("Monetary")).alias("avg_monetary"),
        ratio(F.sum(score_tenths()), F.count("RFM_Score") * 10).alias("avg_rfm_score"),
    )


def top_champions(rfm: DataFrame, n: int = 10) -> DataFrame:
    best = rfm.where(F.col("RFM_Segment") == SEGMENT_NAMES[0]).select(
        "CustomerID", "Recency", "Frequency", "Monetary", "RFM_Score"
    )
    return top_n(best, "RFM_Score", [F.col("Monetary").desc(), F.col("CustomerID")], n)


def box_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum of a value per group."""
    points = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], keys=[key])
    names = ["Min", "Q1", "Median", "Q3", "Max"]
    return points.select(key, *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)])
