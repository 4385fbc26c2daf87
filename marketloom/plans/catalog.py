"""Named queries: how Spark builds each one, and the SQL another engine should agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import prepare
from marketloom.sources.samples import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None = None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return money_to_double(self.build(Tables(prepare(spark), sf_dir)))


_QUERIES: dict[str, Query] = {}


def add(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"query {name} is already there")
    _QUERIES[name] = Query(name, build, None if sql is None else with_ctes(sql))


def all_queries() -> dict[str, Query]:
    # Importing the modules fills the catalogue.
    from marketloom.plans import basics, customers, forecasts, models, products, sales, scored, storage  # noqa: F401

    return dict(_QUERIES)


def money_to_double(df: DataFrame) -> DataFrame:
    """Decimals stay exact up to here and leave as doubles."""
    money = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in money}) if money else df


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Columns whose last bits depend on summation order, at a fixed precision."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


# ------------------------------------------------------------------ check SQL

def _segmented(source: str) -> str:
    return f"""
        SELECT *, CASE WHEN tenths >= 45 THEN 'Champions' WHEN tenths >= 40 THEN 'Loyal Customers'
                       WHEN tenths >= 35 THEN 'Potential Loyalists' WHEN tenths >= 30 THEN 'Recent Customers'
                       WHEN tenths >= 25 THEN 'Promising' WHEN tenths >= 20 THEN 'Needs Attention'
                       WHEN tenths >= 15 THEN 'At Risk' ELSE 'Lost' END AS RFM_Segment,
               CASE WHEN R_Score <= 2 THEN 'High' WHEN R_Score = 3 THEN 'Medium' ELSE 'Low' END AS Churn_Risk,
               CAST(tenths AS DOUBLE) / 10 AS RFM_Score
        FROM (SELECT *, 3 * R_Score + 3 * F_Score + 4 * M_Score AS tenths FROM {source})"""


CTES = {
    "invoices": """
        SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(l_partkey AS VARCHAR) AS StockCode,
               p_name AS Description,
               CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS Quantity,
               o_orderdate AS InvoiceDate, CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
               n_name AS Country
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "lines": """
        SELECT *, CAST(month(InvoiceDate) AS INTEGER) AS Month, CAST(year(InvoiceDate) AS INTEGER) AS Year,
               CAST(Quantity * UnitPrice AS DECIMAL(18,2)) AS TotalAmount
        FROM invoices""",
    "sales": "SELECT * FROM lines WHERE Quantity > 0 AND UnitPrice > 0",
    "cust_sales": "SELECT * FROM sales WHERE TotalAmount > 0 AND CustomerID IS NOT NULL",
    "country_sales": """
        SELECT Country, SUM(TotalAmount) AS TotalSales FROM sales GROUP BY Country""",
    "months": """
        SELECT Year, Month, SUM(TotalAmount) AS MonthlySales FROM sales GROUP BY Year, Month""",
    "month_summary": """
        SELECT Year AS year, Month AS month, SUM(TotalAmount) AS total_revenue,
               COUNT(DISTINCT CustomerID) AS unique_customers, COUNT(DISTINCT InvoiceNo) AS total_orders,
               CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(TotalAmount) AS avg_order_value,
               CAST(SUM(Quantity) AS BIGINT) AS total_items_sold
        FROM sales WHERE TotalAmount > 0 GROUP BY Year, Month""",
    "rfm_fixed_metrics": """
        SELECT CustomerID,
               CAST(date_diff('day', CAST(MAX(InvoiceDate) AS DATE), (SELECT CAST(MAX(InvoiceDate) AS DATE)
                    FROM sales WHERE CustomerID IS NOT NULL AND TotalAmount > 0)) AS INTEGER) AS Recency,
               COUNT(InvoiceNo) AS Frequency, SUM(TotalAmount) AS Monetary
        FROM sales WHERE CustomerID IS NOT NULL AND TotalAmount > 0 GROUP BY CustomerID""",
    "rfm_fixed_scores": """
        SELECT *,
          CAST(CASE WHEN Recency <= 30 THEN 5 WHEN Recency <= 60 THEN 4 WHEN Recency <= 90 THEN 3
               WHEN Recency <= 180 THEN 2 ELSE 1 END AS INTEGER) AS R_Score,
          CAST(CASE WHEN Frequency >= 50 THEN 5 WHEN Frequency >= 20 THEN 4 WHEN Frequency >= 10 THEN 3
               WHEN Frequency >= 5 THEN 2 ELSE 1 END AS INTEGER) AS F_Score,
          CAST(CASE WHEN Monetary >= 5000 THEN 5 WHEN Monetary >= 2000 THEN 4 WHEN Monetary >= 1000 THEN 3
               WHEN Monetary >= 500 THEN 2 ELSE 1 END AS INTEGER) AS M_Score
        FROM rfm_fixed_metrics""",
    "rfm_fixed": _segmented("rfm_fixed_scores"),
    "rfm_metrics": """
        SELECT CustomerID,
               CAST(date_sub('day', MAX(InvoiceDate), (SELECT MAX(InvoiceDate) FROM cust_sales)
                    + INTERVAL 1 DAY) AS INTEGER) AS Recency,
               COUNT(DISTINCT InvoiceNo) AS Frequency, SUM(TotalAmount) AS Monetary
        FROM cust_sales GROUP BY CustomerID""",
    "rfm_points": """
        SELECT 'Recency' AS Metric, quantile_cont(CAST(Recency AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q
        FROM rfm_metrics
        UNION ALL SELECT 'Frequency', quantile_cont(CAST(Frequency AS DOUBLE), [0.2, 0.4, 0.6, 0.8])
        FROM rfm_metrics
        UNION ALL SELECT 'Monetary', quantile_cont(CAST(Monetary AS DOUBLE), [0.2, 0.4, 0.6, 0.8])
        FROM rfm_metrics""",
    "rfm_edges": """
        SELECT Metric, ROUND(q[1], 6) AS q20, ROUND(q[2], 6) AS q40, ROUND(q[3], 6) AS q60,
               ROUND(q[4], 6) AS q80 FROM rfm_points""",
    "rfm_scores": """
        SELECT m.*,
          CAST(CASE WHEN m.Recency <= r.q20 THEN 5 WHEN m.Recency <= r.q40 THEN 4
               WHEN m.Recency <= r.q60 THEN 3 WHEN m.Recency <= r.q80 THEN 2 ELSE 1 END AS INTEGER) AS R_Score,
          CAST(CASE WHEN m.Frequency >= f.q80 THEN 5 WHEN m.Frequency >= f.q60 THEN 4
               WHEN m.Frequency >= f.q40 THEN 3 WHEN m.Frequency >= f.q20 THEN 2 ELSE 1 END AS INTEGER) AS F_Score,
          CAST(CASE WHEN CAST(m.Monetary AS DOUBLE) >= s.q80 THEN 5 WHEN CAST(m.Monetary AS DOUBLE) >= s.q60 THEN 4
               WHEN CAST(m.Monetary AS DOUBLE) >= s.q40 THEN 3 WHEN CAST(m.Monetary AS DOUBLE) >= s.q20 THEN 2
               ELSE 1 END AS INTEGER) AS M_Score
        FROM rfm_metrics m
        JOIN rfm_edges r ON r.Metric = 'Recency' JOIN rfm_edges f ON f.Metric = 'Frequency'
        JOIN rfm_edges s ON s.Metric = 'Monetary'""",
    "rfm_quintile": _segmented("rfm_scores"),
    "split_cut": "SELECT MAX(InvoiceDate) - INTERVAL 30 DAY AS cut FROM cust_sales",
    "history": "SELECT s.* FROM cust_sales s, split_cut WHERE InvoiceDate < cut",
    "observation": "SELECT s.* FROM cust_sales s, split_cut WHERE InvoiceDate >= cut",
    "invoice_features": """
        SELECT CustomerID, InvoiceNo, SUM(TotalAmount) AS total, COUNT(*) AS lines_n, MIN(InvoiceDate) AS d0,
               MAX(InvoiceDate) AS d1, MIN(Country) AS country,
               SUM(CASE WHEN InvoiceDate >= cut - INTERVAL 90 DAY THEN 1 ELSE 0 END) AS recent
        FROM history, split_cut GROUP BY CustomerID, InvoiceNo""",
    "churn_features": """
        SELECT CustomerID, CAST(date_sub('day', last_d, cut) AS INTEGER) AS Recency,
               CAST(n AS BIGINT) AS Frequency, CAST(money AS DOUBLE) AS Monetary,
               CAST(money AS DOUBLE) / n AS AvgOrderValue,
               CAST(date_sub('day', first_d, cut) AS INTEGER) AS TenureDays,
               ROUND(COALESCE(variability, 0), 4) AS PurchaseVariability,
               CASE WHEN n <= 1 THEN CAST(date_sub('day', first_d, cut) AS DOUBLE)
                    WHEN inv = 1 THEN CAST(0 AS DOUBLE)
                    ELSE CAST(date_sub('day', first_d, last_start) AS DOUBLE) / (inv - 1) END AS AvgDaysBetween,
               products AS ProductDiversity, CAST(home AS INTEGER) AS IsUK,
               CAST(recent AS BIGINT) AS Transactions90d,
               CAST(CASE WHEN CustomerID IN (SELECT CustomerID FROM observation) THEN 0 ELSE 1 END AS INTEGER)
                 AS Churned
        FROM (SELECT CustomerID, MAX(d1) AS last_d, MIN(d0) AS first_d, MAX(d0) AS last_start,
                     SUM(lines_n) AS n, SUM(total) AS money, stddev_samp(CAST(total AS DOUBLE)) AS variability,
                     COUNT(*) AS inv, SUM(recent) AS recent, MIN(country) = 'NATION_0' AS home
              FROM invoice_features GROUP BY CustomerID)
        JOIN (SELECT CustomerID, COUNT(DISTINCT StockCode) AS products FROM history GROUP BY CustomerID)
          USING (CustomerID), split_cut""",
    "recency_risk": """
        SELECT CustomerID, Recency, Churned, ChurnRisk,
               CASE WHEN ChurnRisk <= 0.3 THEN 'Low' WHEN ChurnRisk <= 0.6 THEN 'Medium' ELSE 'High' END
                 AS ChurnRiskLevel,
               CASE WHEN ChurnRisk >= 0.25 THEN 1 ELSE 0 END AS Guess
        FROM (SELECT *, LEAST(CAST(Recency AS DOUBLE) / 365, CAST(1 AS DOUBLE)) AS ChurnRisk FROM churn_features)""",
    "order_groups": """
        SELECT *, CAST(LEAST(TotalOrders, 4) - 1 AS INTEGER) AS Cluster
        FROM (SELECT CustomerID, SUM(TotalAmount) AS TotalSpending, COUNT(DISTINCT InvoiceNo) AS TotalOrders,
                     CAST(SUM(Quantity) AS BIGINT) AS TotalItems,
                     CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(DISTINCT InvoiceNo) AS AvgOrderValue
              FROM cust_sales GROUP BY CustomerID)""",
    "order_centers": """
        SELECT Cluster, CAST(SUM(TotalSpending) AS DOUBLE) / COUNT(*) AS ClusterSpending,
               CAST(SUM(TotalOrders) AS DOUBLE) / COUNT(*) AS ClusterOrders, COUNT(*) AS Customers
        FROM order_groups GROUP BY Cluster""",
    "order_medians": """
        SELECT median(CAST(TotalSpending AS DOUBLE)) AS mid_spending, median(CAST(TotalOrders AS DOUBLE)) AS mid_orders
        FROM order_groups""",
    "order_segments": """
        SELECT g.*, CASE WHEN ClusterSpending > mid_spending * 2 AND ClusterOrders > mid_orders THEN 'High Value Frequent'
                         WHEN ClusterSpending > mid_spending * 2 THEN 'High Value Occasional'
                         WHEN ClusterOrders > mid_orders THEN 'Regular Shoppers' ELSE 'Low Engagement' END AS Segment
        FROM order_groups g JOIN order_centers c USING (Cluster), order_medians""",
    "stats": """
        SELECT CAST(SUM(Quantity) AS DOUBLE) / COUNT(Quantity) AS mean_qty,
               stddev_samp(CAST(Quantity AS DOUBLE)) AS std_qty,
               CAST(SUM(UnitPrice) AS DOUBLE) / COUNT(UnitPrice) AS mean_price,
               stddev_samp(CAST(UnitPrice AS DOUBLE)) AS std_price,
               CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(TotalAmount) AS mean_amount,
               stddev_samp(CAST(TotalAmount AS DOUBLE)) AS std_amount
        FROM sales WHERE TotalAmount > 0""",
    "z": """
        SELECT s.*, COALESCE(ABS((CAST(Quantity AS DOUBLE) - mean_qty) / NULLIF(std_qty, 0)), 0) AS qty_zscore,
               COALESCE(ABS((CAST(UnitPrice AS DOUBLE) - mean_price) / NULLIF(std_price, 0)), 0) AS price_zscore,
               COALESCE(ABS((CAST(TotalAmount AS DOUBLE) - mean_amount) / NULLIF(std_amount, 0)), 0)
                 AS amount_zscore
        FROM sales s, stats WHERE TotalAmount > 0""",
    "flagged": """
        SELECT *, CASE WHEN anomaly_score >= 1.3 THEN 'Critical' WHEN anomaly_score >= 1.1 THEN 'High'
                       WHEN anomaly_score >= 0.9 THEN 'Medium' ELSE 'Low' END AS severity
        FROM (SELECT *, CAST(CASE WHEN qty_zscore > 1.5 OR price_zscore > 1.5 OR amount_zscore > 1.5 THEN 1
                             ELSE 0 END AS INTEGER) AS is_anomaly,
                     CASE WHEN qty_zscore > 1.5 THEN 'High Quantity' WHEN price_zscore > 1.5 THEN 'High Price'
                          WHEN amount_zscore > 1.5 THEN 'High Amount' ELSE 'Normal' END AS anomaly_type,
                     (qty_zscore + price_zscore + amount_zscore) / CAST(3 AS DOUBLE) AS anomaly_score
              FROM z)""",
    "basket_n": """
        SELECT InvoiceNo, COUNT(*) AS Lines FROM sales WHERE Description IS NOT NULL
        GROUP BY InvoiceNo HAVING COUNT(*) >= 2""",
    "basket_rows": """
        SELECT DISTINCT InvoiceNo, Description AS Item FROM sales
        WHERE Description IS NOT NULL AND InvoiceNo IN (SELECT InvoiceNo FROM basket_n)""",
    "pair_counts": """
        SELECT a.Item AS Product_A, b.Item AS Product_B, COUNT(*) AS Frequency
        FROM basket_rows a JOIN basket_rows b ON a.InvoiceNo = b.InvoiceNo AND a.Item < b.Item
        GROUP BY 1, 2""",
    "top_pairs": """
        SELECT Product_A, Product_B, Frequency,
               ROUND(CAST(Frequency AS DOUBLE) / (SELECT COUNT(*) FROM basket_n) * 100, 2) AS Support
        FROM pair_counts WHERE Frequency >= 0.003 * (SELECT COUNT(*) FROM basket_n)
        ORDER BY Frequency DESC, Product_A, Product_B LIMIT 100""",
    "product_first": """
        SELECT StockCode, Description, UnitPrice AS FirstPrice FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY StockCode
                    ORDER BY InvoiceDate, Description, UnitPrice) AS rn
          FROM cust_sales WHERE Description IS NOT NULL) WHERE rn = 1""",
    "product_info": """
        SELECT StockCode, p.Description, p.FirstPrice, a.AveragePrice FROM product_first p
        JOIN (SELECT StockCode, CAST(SUM(UnitPrice) AS DOUBLE) / COUNT(UnitPrice) AS AveragePrice
              FROM cust_sales WHERE Description IS NOT NULL GROUP BY StockCode) a USING (StockCode)""",
    "latest": """
        SELECT InvoiceNo FROM cust_sales WHERE Description IS NOT NULL GROUP BY InvoiceNo
        ORDER BY MAX(InvoiceDate) DESC, InvoiceNo DESC LIMIT 5000""",
    "items": """
        SELECT DISTINCT InvoiceNo, StockCode FROM cust_sales
        WHERE Description IS NOT NULL AND InvoiceNo IN (SELECT InvoiceNo FROM latest)""",
    "inter": """
        SELECT CustomerID, StockCode, SUM(TotalAmount) AS Spend FROM cust_sales
        WHERE Description IS NOT NULL GROUP BY CustomerID, StockCode""",
    "scaled": """
        SELECT CustomerID, StockCode,
               COALESCE((CAST(Spend AS DOUBLE) - lo) / NULLIF(hi - lo, 0), 0) AS Scaled
        FROM inter JOIN (
          SELECT StockCode, MAX(CAST(Spend AS DOUBLE)) AS hi,
                 CASE WHEN COUNT(*) < (SELECT COUNT(DISTINCT CustomerID) FROM inter) THEN CAST(0 AS DOUBLE)
                      ELSE MIN(CAST(Spend AS DOUBLE)) END AS lo
          FROM inter GROUP BY StockCode) USING (StockCode)""",
    "customer_unit": """
        SELECT CustomerID AS id, StockCode AS f,
               Scaled / SQRT(SUM(Scaled * Scaled) OVER (PARTITION BY CustomerID)) AS w
        FROM scaled WHERE Scaled <> 0""",
    "product_unit": """
        SELECT StockCode AS id, CustomerID AS f,
               Scaled / SQRT(SUM(Scaled * Scaled) OVER (PARTITION BY StockCode)) AS w
        FROM scaled WHERE Scaled <> 0""",
    "described": """
        SELECT id, f, w / SQRT(SUM(w * w) OVER (PARTITION BY id)) AS w
        FROM (SELECT CustomerID AS id, Description AS f, CAST(SUM(TotalAmount) AS DOUBLE) AS w
              FROM cust_sales WHERE Description IS NOT NULL GROUP BY 1, 2 HAVING SUM(TotalAmount) <> 0)""",
    "customer_near": """
        SELECT * FROM (
          SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY Similarity DESC, Neighbour)
                    AS INTEGER) AS Rank
          FROM (SELECT a.id AS CustomerID, b.id AS Neighbour, ROUND(SUM(a.w * b.w), 9) AS Similarity
                FROM customer_unit a JOIN customer_unit b ON a.f = b.f AND a.id <> b.id GROUP BY 1, 2))
        WHERE Rank <= 10""",
    "unseen": """
        SELECT n.CustomerID, i.StockCode,
               SUM(CAST(n.Similarity AS DECIMAL(10,9)) * CAST(i.Spend AS DECIMAL(18,2))) AS Score
        FROM customer_near n JOIN inter i ON i.CustomerID = n.Neighbour
        WHERE n.Rank <= 5 AND NOT EXISTS (SELECT 1 FROM inter o WHERE o.CustomerID = n.CustomerID
                                          AND o.StockCode = i.StockCode)
        GROUP BY 1, 2""",
    "recs": """
        SELECT u.CustomerID, u.StockCode AS ProductStockCode, p.Description AS ProductDescription,
               CAST(u.Score AS DOUBLE) AS RecommendationScore, CAST(u.rn AS INTEGER) AS Rank, p.AveragePrice,
               COALESCE(regexp_extract(trim(p.Description), '^\\S+'), 'Unknown') AS ProductCategory
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY CustomerID ORDER BY Score DESC, StockCode) AS rn
              FROM unseen) u JOIN product_info p USING (StockCode) WHERE rn <= 5""",
    # Least squares by orthogonal steps: e1, e2, e3 are the inputs without what the ones before explain.
    "index_rows": """
        SELECT *, place < greatest(ceil(n * CAST(0.8 AS DOUBLE)), 1) AS train FROM (
          SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS y, (Year - 2010) * 12 + Month AS x1, Month AS x2,
                 COALESCE(AVG(CAST(MonthlySales AS DOUBLE)) OVER (ORDER BY Year, Month
                          ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), 0) AS x3,
                 ROW_NUMBER() OVER (ORDER BY Year, Month) - 1 AS place, COUNT(*) OVER () AS n, 'Historical' AS Type
          FROM months)
        UNION ALL
        SELECT CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER), NULL, (year(d) - 2010) * 12 + month(d), month(d),
               (SELECT max_by(CAST(MonthlySales AS DOUBLE), (Year - 2010) * 12 + Month) FROM months),
               NULL, NULL, 'Forecast', FALSE
        FROM (SELECT (SELECT MAX(make_date(Year, Month, 1)) FROM months) + to_months(CAST(i AS INTEGER)) AS d
              FROM range(1, 4) AS steps(i))""",
    "index_one": "SELECT *, x1 - (SELECT AVG(x1) FROM index_rows WHERE train) AS e1 FROM index_rows",
    "index_two": """
        SELECT *, x2 - (SELECT AVG(x2) FROM index_one WHERE train)
                  - e1 * (SELECT SUM(e1 * x2) / SUM(e1 * e1) FROM index_one WHERE train) AS e2
        FROM index_one""",
    "index_three": """
        SELECT *, x3 - (SELECT AVG(x3) FROM index_two WHERE train)
                  - e1 * (SELECT SUM(e1 * x3) / SUM(e1 * e1) FROM index_two WHERE train)
                  - e2 * (SELECT SUM(e2 * x3) / SUM(e2 * e2) FROM index_two WHERE train) AS e3
        FROM index_two""",
    "index_fit": """
        SELECT r.Year, r.Month, r.y AS ActualSales, m + g1 * e1 + g2 * e2 + g3 * e3 AS PredictedSales, r.Type
        FROM index_three r, (SELECT AVG(y) AS m, SUM(e1 * y) / SUM(e1 * e1) AS g1, SUM(e2 * y) / SUM(e2 * e2) AS g2,
                                    SUM(e3 * y) / SUM(e3 * e3) AS g3 FROM index_three WHERE train)""",
}

def _mentions(text: str) -> set[str]:
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    return words & CTES.keys()


def with_ctes(body: str) -> str:
    """The query with the definitions it mentions, and those they mention, in front."""
    needed: set[str] = set()
    pending = _mentions(body)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending |= _mentions(CTES[name])
    ordered = [name for name in CTES if name in needed]
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + body
