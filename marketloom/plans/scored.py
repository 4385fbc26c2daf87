"""Reports and quality figures over scores and groups that plain SQL can make too.

The fitted models have no SQL twin, so the operators behind them are also registered on a risk that is the share
of a year since the last purchase, and on customer groups by number of orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.operators import baskets, churn, evaluation, marts, reports, rfm, segments
from marketloom.plans.catalog import add, rounded

# ------------------------------------------------------------- risk by recency


def _scored(t):
    risk = F.least(F.col("Recency") / F.lit(365.0), F.lit(1.0))
    features = churn.churn_features(t.customer_sales, home="NATION_0").withColumn("ChurnRisk", risk)
    guess = (F.col("ChurnRisk") >= 0.25).cast("double")
    return features.withColumns(
        {"ChurnRiskLevel": churn.risk_level(), "ChurnPrediction": guess, "rawPrediction": F.col("ChurnRisk")}
    )


def _quality(name):
    return lambda t: rounded(
        evaluation.binary_metrics(_scored(t), "Churned", "ChurnPrediction", names=[name]), 9, "value"
    )


add(
    "churn_risk_levels_by_recency",
    lambda t: reports.distribution(_scored(t), "ChurnRiskLevel"),
    "SELECT ChurnRiskLevel, COUNT(*) AS count FROM recency_risk GROUP BY 1",
)
add(
    "churn_risk_summary_by_recency",
    lambda t: rounded(churn.risk_summary(_scored(t)), 9, "avg_probability"),
    """SELECT ChurnRiskLevel, COUNT(*) AS customer_count, ROUND(AVG(ChurnRisk), 9) AS avg_probability,
              CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM recency_risk) * 100 AS pct
       FROM recency_risk GROUP BY 1""",
)
add(
    "churn_by_recency_bin_by_recency",
    lambda t: rounded(churn.churn_by_recency_bin(_scored(t)), 7, "AvgChurnRiskPct"),
    """SELECT CASE WHEN Recency <= 30 THEN '0-30d' WHEN Recency <= 60 THEN '30-60d'
                   WHEN Recency <= 90 THEN '60-90d' ELSE '90d+' END AS RecencyBin,
              ROUND(AVG(ChurnRisk) * 100, 7) AS AvgChurnRiskPct, COUNT(*) AS Customers
       FROM recency_risk GROUP BY 1""",
)
add(
    "churn_extremes_by_recency",
    lambda t: churn.churn_extremes(_scored(t).select("CustomerID", "Recency", "ChurnRisk"), riskiest=10, loyal=5),
    """(SELECT CustomerID, Recency, ChurnRisk, 'Highest risk' AS Side FROM recency_risk
        ORDER BY ChurnRisk DESC, CustomerID LIMIT 10)
       UNION ALL (SELECT CustomerID, Recency, ChurnRisk, 'Most loyal' FROM recency_risk
                  ORDER BY ChurnRisk, CustomerID DESC LIMIT 5)""",
)
add(
    "eval_auc_by_recency",
    _quality("auc"),
    """SELECT 'auc' AS metric,
              ROUND((SUM(CASE WHEN Churned = 1 THEN place ELSE 0 END) - n1 * (n1 + 1) / 2) / (n1 * n0), 9) AS value
       FROM (SELECT Churned, RANK() OVER (ORDER BY ChurnRisk) + (COUNT(*) OVER (PARTITION BY ChurnRisk) - 1) / 2.0
                    AS place,
                    CAST(SUM(Churned) OVER () AS DOUBLE) AS n1, CAST(SUM(1 - Churned) OVER () AS DOUBLE) AS n0
             FROM recency_risk) GROUP BY n1, n0""",
)
add(
    "eval_accuracy_by_recency",
    _quality("accuracy"),
    """SELECT 'accuracy' AS metric, ROUND(AVG(CASE WHEN Guess = Churned THEN 1.0 ELSE 0.0 END), 9) AS value
       FROM recency_risk""",
)
add(
    "eval_precision_by_recency",
    _quality("precision"),
    """SELECT 'precision' AS metric, ROUND(SUM(share * COALESCE(hits / NULLIF(said, 0), 0)), 9) AS value
       FROM (SELECT c, CAST(SUM(CASE WHEN Guess = c AND Churned = c THEN 1 ELSE 0 END) AS DOUBLE) AS hits,
                    CAST(SUM(CASE WHEN Guess = c THEN 1 ELSE 0 END) AS DOUBLE) AS said,
                    AVG(CASE WHEN Churned = c THEN 1.0 ELSE 0.0 END) AS share
             FROM recency_risk, (VALUES (0), (1)) AS classes(c) GROUP BY c)""",
)
add(
    "eval_class_report_by_recency",
    lambda t: rounded(
        evaluation.class_report(_scored(t), "Churned", "ChurnPrediction"), 9, "precision", "recall", "f1"
    ),
    """SELECT class, ROUND(p, 9) AS precision, ROUND(r, 9) AS recall,
              ROUND(COALESCE(2 * p * r / NULLIF(p + r, 0), 0), 9) AS f1, support
       FROM (SELECT c AS class, COALESCE(CAST(hits AS DOUBLE) / NULLIF(said, 0), 0) AS p,
                    COALESCE(CAST(hits AS DOUBLE) / NULLIF(support, 0), 0) AS r, support
             FROM (SELECT c, CAST(SUM(CASE WHEN Guess = c AND Churned = c THEN 1 ELSE 0 END) AS BIGINT) AS hits,
                          CAST(SUM(CASE WHEN Guess = c THEN 1 ELSE 0 END) AS BIGINT) AS said,
                          CAST(SUM(CASE WHEN Churned = c THEN 1 ELSE 0 END) AS BIGINT) AS support
                   FROM recency_risk, (VALUES (0), (1)) AS classes(c) GROUP BY c))
       WHERE support > 0""",
)

# ------------------------------------------------------------ groups by orders


def _grouped(t):
    features = marts.customer_order_features(t.customer_sales)
    return features.withColumn("Cluster", (F.least("TotalOrders", F.lit(4)) - 1).cast("int"))


def _named(t):
    return segments.segment_names(_grouped(t))


add(
    "cluster_centers_by_orders",
    lambda t: segments.cluster_centers(_grouped(t)),
    "SELECT * FROM order_centers",
)
add(
    "cluster_profile_join_by_orders",
    lambda t: segments.cluster_profile(_grouped(t)),
    """SELECT g.CustomerID, CAST(g.TotalSpending AS DOUBLE) AS TotalSpending, g.TotalOrders, g.TotalItems,
              g.AvgOrderValue, g.Cluster, ClusterSpending, ClusterOrders
       FROM order_groups g JOIN order_centers USING (Cluster)""",
)
add(
    "segment_names_by_orders",
    _named,
    """SELECT CustomerID, CAST(TotalSpending AS DOUBLE) AS TotalSpending, TotalOrders, TotalItems, AvgOrderValue,
              Cluster, Segment FROM order_segments""",
)
add(
    "segment_rank_names_by_orders",
    lambda t: segments.segment_rank_names(_grouped(t)),
    """SELECT CustomerID, CAST(TotalSpending AS DOUBLE) AS TotalSpending, TotalOrders, TotalItems, AvgOrderValue,
              g.Cluster AS SegmentID,
              ['VIP Customers', 'Regular Customers', 'Occasional Buyers', 'New Customers'][place] AS SegmentName
       FROM order_groups g
       JOIN (SELECT Cluster, ROW_NUMBER() OVER (ORDER BY ClusterSpending DESC, Cluster) AS place
             FROM order_centers) USING (Cluster)""",
)
add(
    "segment_metrics_by_orders",
    lambda t: segments.segment_metrics(_named(t)),
    """SELECT Segment, COUNT(CustomerID) AS Customers, CAST(SUM(TotalSpending) AS DOUBLE) AS TotalRevenue,
              ROUND(CAST(SUM(TotalSpending) AS DOUBLE) / COUNT(*), 2) AS AvgSpending,
              ROUND(CAST(SUM(TotalOrders) AS DOUBLE) / COUNT(*), 2) AS AvgOrders,
              ROUND(CAST(SUM(TotalItems) AS DOUBLE) / COUNT(*), 2) AS AvgItems,
              ROUND(AVG(AvgOrderValue), 2) AS AvgOrderValue
       FROM order_segments GROUP BY Segment""",
)
add(
    "segment_distribution_pct_by_orders",
    lambda t: reports.distribution_pct(_named(t), "Segment"),
    """SELECT Segment, COUNT(*) AS count,
              CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM order_segments) * 100 AS pct
       FROM order_segments GROUP BY Segment""",
)
add(
    "spend_box_stats_by_orders",
    lambda t: rounded(
        rfm.box_stats(_named(t), "Segment", "TotalSpending"), 4, "Min", "Q1", "Median", "Q3", "Max"
    ),
    """SELECT Segment, ROUND(q[1], 4) AS Min, ROUND(q[2], 4) AS Q1, ROUND(q[3], 4) AS Median,
              ROUND(q[4], 4) AS Q3, ROUND(q[5], 4) AS Max
       FROM (SELECT Segment, quantile_cont(CAST(TotalSpending AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS q
             FROM order_segments GROUP BY Segment)""",
)

# ------------------------------------------------------------ itemsets of up to three

add(
    "frequent_itemset_triples",
    lambda t: baskets.frequent_itemsets(t.sales, 0.0005, 0.03)
    .freqItemsets.where(F.size("items") <= 3)
    .select(F.array_join(F.array_sort("items"), " + ").alias("items"), F.size("items").alias("length"), "freq"),
    """SELECT Item AS items, 1 AS length, COUNT(*) AS freq FROM basket_rows GROUP BY Item
       HAVING COUNT(*) >= 0.0005 * (SELECT COUNT(*) FROM basket_n)
       UNION ALL SELECT Product_A || ' + ' || Product_B, 2, Frequency FROM pair_counts
       WHERE Frequency >= 0.0005 * (SELECT COUNT(*) FROM basket_n)
       UNION ALL SELECT a.Item || ' + ' || b.Item || ' + ' || c.Item, 3, COUNT(*)
       FROM basket_rows a JOIN basket_rows b ON a.InvoiceNo = b.InvoiceNo AND a.Item < b.Item
       JOIN basket_rows c ON b.InvoiceNo = c.InvoiceNo AND b.Item < c.Item GROUP BY 1
       HAVING COUNT(*) >= 0.0005 * (SELECT COUNT(*) FROM basket_n)""",
)
