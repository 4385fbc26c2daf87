"""Customer value, lifecycle and churn inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.keys import train_test_split
from marketloom.operators import churn, cleaning, features, marts, reports, rfm
from marketloom.plans.catalog import add, rounded
from marketloom.session import stored

RFM_COLUMNS = """CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, R_Score, F_Score, M_Score,
              RFM_Score, RFM_Segment, Churn_Risk"""

add(
    "rfm_fixed",
    lambda t: rfm.rfm_fixed(t.sales),
    f"SELECT {RFM_COLUMNS} FROM rfm_fixed",
)
add(
    "rfm_quintile",
    lambda t: rfm.rfm_quintile(t.customer_sales),
    f"SELECT {RFM_COLUMNS} FROM rfm_quintile",
)
add(
    "quintiles",
    lambda t: rounded(
        rfm.rfm_quintiles(rfm.rfm_metrics(t.customer_sales)), 6, "q20", "q40", "q60", "q80"
    ),
    "SELECT Metric, q20, q40, q60, q80 FROM rfm_edges",
)
add(
    "rfm_segment_distribution",
    lambda t: reports.distribution(rfm.rfm_fixed(t.sales), "RFM_Segment"),
    "SELECT RFM_Segment, COUNT(*) AS count FROM rfm_fixed GROUP BY RFM_Segment",
)
add(
    "distribution_pct",
    lambda t: reports.distribution_pct(rfm.rfm_quintile(t.customer_sales), "RFM_Segment"),
    """SELECT RFM_Segment, COUNT(*) AS count,
              CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM rfm_quintile) * 100 AS pct
       FROM rfm_quintile GROUP BY RFM_Segment""",
)
add(
    "churn_risk_distribution_pct",
    lambda t: reports.distribution_pct(rfm.rfm_quintile(t.customer_sales), "Churn_Risk"),
    """SELECT Churn_Risk, COUNT(*) AS count,
              CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM rfm_quintile) * 100 AS pct
       FROM rfm_quintile GROUP BY Churn_Risk""",
)
add(
    "rfm_segment_metrics",
    lambda t: rfm.segment_metrics(rfm.rfm_quintile(t.customer_sales)),
    """SELECT RFM_Segment, COUNT(CustomerID) AS Customers,
              ROUND(CAST(SUM(Recency) AS DOUBLE) / COUNT(Recency), 2) AS AvgRecency,
              ROUND(CAST(SUM(Frequency) AS DOUBLE) / COUNT(Frequency), 2) AS AvgFrequency,
              ROUND(CAST(SUM(Monetary) AS DOUBLE) / COUNT(Monetary), 2) AS AvgMonetary,
              ROUND(CAST(SUM(tenths) AS DOUBLE) / (COUNT(RFM_Score) * 10), 2) AS AvgScore
       FROM rfm_quintile GROUP BY RFM_Segment""",
)
add(
    "rfm_segment_by_risk",
    lambda t: rfm.segment_by_risk(rfm.rfm_fixed(t.sales)),
    """SELECT RFM_Segment, Churn_Risk, COUNT(*) AS customer_count,
              CAST(SUM(Recency) AS DOUBLE) / COUNT(Recency) AS avg_recency_days,
              CAST(SUM(Frequency) AS DOUBLE) / COUNT(Frequency) AS avg_frequency,
              CAST(SUM(Monetary) AS DOUBLE) / COUNT(Monetary) AS avg_monetary,
              CAST(SUM(tenths) AS DOUBLE) / (COUNT(RFM_Score) * 10) AS avg_rfm_score
       FROM rfm_fixed GROUP BY RFM_Segment, Churn_Risk""",
)
add(
    "rfm_score_histogram",
    lambda t: reports.score_histogram(rfm.rfm_quintile(t.customer_sales), "RFM_Score", 20),
    """SELECT CAST(LEAST(FLOOR(COALESCE((RFM_Score - lo) / NULLIF(hi - lo, 0) * 20, 0)), 19) + 1 AS INTEGER) AS bin,
              COUNT(*) AS count
       FROM rfm_quintile, (SELECT MIN(RFM_Score) AS lo, MAX(RFM_Score) AS hi FROM rfm_quintile) GROUP BY 1""",
)
add(
    "top_champions",
    lambda t: rfm.top_champions(rfm.rfm_quintile(t.customer_sales), 20),
    """SELECT CustomerID, Recency, Frequency, CAST(Monetary AS DOUBLE) AS Monetary, RFM_Score FROM rfm_quintile
       WHERE RFM_Segment = 'Champions' ORDER BY tenths DESC, rfm_quintile.Monetary DESC, CustomerID LIMIT 20""",
)
add(
    "spend_box_stats_by_rfm",
    lambda t: rounded(
        rfm.box_stats(rfm.rfm_quintile(t.customer_sales), "RFM_Segment", "Monetary"),
        4,
        "Min",
        "Q1",
        "Median",
        "Q3",
        "Max",
    ),
    """SELECT RFM_Segment, ROUND(q[1], 4) AS Min, ROUND(q[2], 4) AS Q1, ROUND(q[3], 4) AS Median,
              ROUND(q[4], 4) AS Q3, ROUND(q[5], 4) AS Max
       FROM (SELECT RFM_Segment, quantile_cont(CAST(Monetary AS DOUBLE), [0, 0.25, 0.5, 0.75, 1]) AS q
             FROM rfm_quintile GROUP BY RFM_Segment)""",
)
add(
    "customer_lifecycle",
    lambda t: rounded(churn.customer_lifecycle(t.sales), 4, "StdOrderValue"),
    """SELECT CustomerID, MIN(InvoiceDate) AS FirstPurchase, MAX(InvoiceDate) AS LastPurchase,
              COUNT(*) AS TotalTransactions, CAST(SUM(TotalAmount) AS DOUBLE) AS TotalSpent,
              CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(TotalAmount) AS AvgOrderValue,
              ROUND(COALESCE(stddev_samp(CAST(TotalAmount AS DOUBLE)), 0), 4) AS StdOrderValue,
              CAST(date_diff('day', CAST(MAX(InvoiceDate) AS DATE), (SELECT CAST(MAX(InvoiceDate) AS DATE)
                   FROM sales WHERE CustomerID IS NOT NULL)) AS INTEGER) AS Recency,
              CAST(date_diff('day', CAST(MIN(InvoiceDate) AS DATE), CAST(MAX(InvoiceDate) AS DATE)) AS INTEGER)
                AS CustomerLifetime
       FROM sales WHERE CustomerID IS NOT NULL GROUP BY CustomerID""",
)


def _churn_features(t):
    return churn.churn_features(t.customer_sales, home="NATION_0")


def _parts(train, test):
    """Both parts of a split as one table."""
    named = [rows.select("CustomerID", F.lit(name).alias("Part")) for rows, name in ((train, "train"), (test, "test"))]
    return named[0].unionByName(named[1])


#: Where a customer stands in a split, as ``hash_position`` has it.
_POSITION = "CAST('0x' || SUBSTR(MD5('42|' || CustomerID), 1, 8) AS BIGINT) >> 1"

add(
    "train_test_split",
    lambda t: _parts(*train_test_split(_churn_features(t), ["CustomerID"], 0.8)),
    f"SELECT CustomerID, CASE WHEN ({_POSITION}) < {int(0.8 * 2**31)} THEN 'train' ELSE 'test' END AS Part FROM churn_features",
)
add(
    "stratified_split",
    lambda t: _parts(*churn.stratified_split(stored(_churn_features(t)), "Churned", ["CustomerID"], 0.8)),
    f"""SELECT CustomerID, CASE WHEN place < cut THEN 'train' ELSE 'test' END AS Part
        FROM (SELECT CustomerID, place, QUANTILE_CONT(place, 0.8) OVER (PARTITION BY Churned) AS cut
              FROM (SELECT CustomerID, Churned, CAST({_POSITION} AS DOUBLE) AS place FROM churn_features))""",
)
add(
    "churn_features",
    lambda t: rounded(_churn_features(t), 4, "PurchaseVariability"),
    "SELECT * FROM churn_features",
)
add(
    "churn_label",
    lambda t: churn.churn_label(
        *(part.select("CustomerID").distinct() for part in cleaning.time_split(t.customer_sales, 30))
    ),
    """SELECT DISTINCT CustomerID, CAST(CASE WHEN CustomerID IN (SELECT CustomerID FROM observation) THEN 0
              ELSE 1 END AS INTEGER) AS Churned FROM history""",
)
add(
    "churn_rate",
    lambda t: churn.churn_rate(
        churn.churn_label(
            *(part.select("CustomerID").distinct() for part in cleaning.time_split(t.customer_sales, 30))
        )
    ),
    """SELECT COUNT(*) AS Customers, CAST(SUM(Churned) AS BIGINT) AS ChurnedCustomers,
              CAST(SUM(1 - Churned) AS BIGINT) AS ActiveCustomers,
              CAST(SUM(Churned) AS DOUBLE) / COUNT(*) * 100 AS ChurnRate FROM churn_features""",
)
add(
    "standard_scaler",
    lambda t: rounded(
        features.standard_scaler(
            marts.customer_order_features(t.customer_sales).select(
                "CustomerID", "TotalSpending", "TotalOrders"
            ),
            ["TotalSpending", "TotalOrders"],
        ),
        6,
        "TotalSpending_scaled",
        "TotalOrders_scaled",
    ),
    """SELECT CustomerID, CAST(m AS DOUBLE) AS TotalSpending, n AS TotalOrders,
              ROUND((CAST(m AS DOUBLE) - AVG(CAST(m AS DOUBLE)) OVER ()) / stddev_samp(CAST(m AS DOUBLE)) OVER (), 6)
                AS TotalSpending_scaled,
              ROUND((CAST(n AS DOUBLE) - AVG(CAST(n AS DOUBLE)) OVER ()) / stddev_samp(CAST(n AS DOUBLE)) OVER (), 6)
                AS TotalOrders_scaled
       FROM (SELECT CustomerID, SUM(TotalAmount) AS m, COUNT(DISTINCT InvoiceNo) AS n FROM cust_sales
             GROUP BY CustomerID)""",
)
