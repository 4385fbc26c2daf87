"""Marts, key figures, top lists and monthly series."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketloom.functions.columns import WEEKDAYS, position_in
from marketloom.operators import anomalies, evaluation, forecast, marts, reports, series
from marketloom.plans.catalog import add, rounded

YEAR_MONTH = ["Year", "Month"]

# ----------------------------------------------------------------------- marts

add(
    "sales_per_country",
    lambda t: marts.sales_per_country(t.sales),
    "SELECT Country, CAST(TotalSales AS DOUBLE) AS TotalSales FROM country_sales",
)
add(
    "monthly_sales",
    lambda t: marts.monthly_sales(t.sales),
    "SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales FROM months",
)
add(
    "customer_metrics",
    lambda t: marts.customer_metrics(t.sales),
    """SELECT CustomerID, CAST(SUM(TotalAmount) AS DOUBLE) AS TotalPurchases,
              COUNT(InvoiceNo) AS NumberOfTransactions FROM sales GROUP BY CustomerID""",
)
add(
    "product_performance",
    lambda t: marts.product_performance(t.sales),
    """SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantitySold,
              CAST(SUM(TotalAmount) AS DOUBLE) AS TotalRevenue FROM sales GROUP BY StockCode, Description""",
)
add(
    "monthly_summary",
    lambda t: marts.monthly_summary(t.sales),
    "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM month_summary",
)
add(
    "daily_summary",
    lambda t: marts.daily_summary(t.sales),
    """SELECT CAST(InvoiceDate AS DATE) AS Date, CAST(SUM(TotalAmount) AS DOUBLE) AS Revenue, COUNT(*) AS Orders,
              CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(TotalAmount) AS AvgOrderValue,
              COUNT(DISTINCT CustomerID) AS UniqueCustomers, CAST(SUM(Quantity) AS BIGINT) AS ItemsSold
       FROM sales WHERE TotalAmount > 0 GROUP BY 1""",
)
add(
    "kpi_overview",
    lambda t: marts.kpi_overview(t.customer_sales),
    """SELECT CAST(SUM(TotalAmount) AS DOUBLE) AS TotalRevenue, COUNT(DISTINCT InvoiceNo) AS TotalOrders,
              COUNT(DISTINCT CustomerID) AS UniqueCustomers, COUNT(DISTINCT Description) AS UniqueProducts,
              CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(DISTINCT InvoiceNo) AS AvgOrderValue FROM cust_sales""",
)
add(
    "kpi_totals",
    lambda t: marts.kpi_totals(t.sales),
    """SELECT COUNT(*) AS TotalTransactions, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantity,
              CAST(SUM(Quantity * UnitPrice) AS DOUBLE) AS TotalRevenue FROM sales""",
)
add(
    "daily_revenue",
    lambda t: marts.daily_revenue(t.customer_sales),
    """SELECT CAST(InvoiceDate AS DATE) AS Date, CAST(SUM(TotalAmount) AS DOUBLE) AS Revenue
       FROM cust_sales GROUP BY 1""",
)
add(
    "year_month_revenue",
    lambda t: marts.year_month_revenue(t.customer_sales),
    """SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, CAST(SUM(TotalAmount) AS DOUBLE) AS Revenue
       FROM cust_sales GROUP BY 1""",
)
add(
    "yearly_revenue",
    lambda t: marts.yearly_revenue(t.sales),
    "SELECT Year, CAST(SUM(TotalAmount) AS DOUBLE) AS Revenue FROM sales GROUP BY Year",
)

_DAYS = ", ".join(f"({i}, '{day}')" for i, day in enumerate(WEEKDAYS))
_DAY_SQL = f"""
    SELECT CAST(i AS INTEGER) AS DayIndex, d AS DayOfWeek, CAST(r AS DOUBLE) AS Revenue
    FROM (VALUES {_DAYS}) v(i, d)
    LEFT JOIN (SELECT dayname(InvoiceDate) AS n, SUM(TotalAmount) AS r FROM {{source}} GROUP BY 1) ON n = d"""
add(
    "revenue_by_day_of_week",
    lambda t: marts.revenue_by_day_of_week(t.customer_sales),
    _DAY_SQL.format(source="cust_sales"),
)
add(
    "reindex_days",
    lambda t: marts.revenue_by_day_of_week(
        t.customer_sales.where(~F.dayofweek("InvoiceDate").isin(1, 7))
    ),
    _DAY_SQL.format(
        source="(SELECT * FROM cust_sales WHERE dayname(InvoiceDate) NOT IN ('Saturday', 'Sunday'))"
    ),
)
add(
    "revenue_by_hour",
    lambda t: marts.revenue_by_hour(
        t.events.withColumn("value", F.col("value").cast("decimal(18,2)")), "ts", "value"
    ),
    """SELECT CAST(hour(ts) AS INTEGER) AS Hour, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS Revenue
       FROM events GROUP BY 1""",
)
add(
    "customers_by_country",
    lambda t: marts.customers_by_country(t.customer_sales, 10),
    """SELECT Country, COUNT(DISTINCT CustomerID) AS Customers FROM cust_sales GROUP BY Country
       ORDER BY Customers DESC, Country LIMIT 10""",
)
add(
    "customer_order_features",
    lambda t: marts.customer_order_features(t.customer_sales),
    """SELECT CustomerID, CAST(SUM(TotalAmount) AS DOUBLE) AS TotalSpending,
              COUNT(DISTINCT InvoiceNo) AS TotalOrders, CAST(SUM(Quantity) AS BIGINT) AS TotalItems,
              CAST(SUM(TotalAmount) AS DOUBLE) / COUNT(DISTINCT InvoiceNo) AS AvgOrderValue
       FROM cust_sales GROUP BY CustomerID""",
)
add(
    "dict_agg",
    lambda t: marts.quantity_per_customer_item(t.customer_sales),
    """SELECT CustomerID, StockCode, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantity
       FROM cust_sales GROUP BY CustomerID, StockCode""",
)
add(
    "distinct_products",
    lambda t: marts.distinct_products(t.sales),
    "SELECT DISTINCT StockCode, Description FROM sales WHERE StockCode IS NOT NULL AND Description IS NOT NULL",
)
add(
    "first_product_info",
    lambda t: marts.product_info(t.customer_sales),
    """SELECT StockCode, Description, CAST(FirstPrice AS DOUBLE) AS FirstPrice, AveragePrice FROM product_info""",
)

# -------------------------------------------------------------------- top lists

add(
    "top_products_by_quantity",
    lambda t: marts.top_products_by_quantity(t.sales, 10),
    """SELECT Description, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantity FROM sales GROUP BY Description
       ORDER BY TotalQuantity DESC, Description LIMIT 10""",
)
add(
    "top_products_by_revenue",
    lambda t: marts.top_products_by_revenue(t.sales, 10),
    """SELECT Description, CAST(SUM(TotalAmount) AS DOUBLE) AS TotalRevenue FROM sales GROUP BY Description
       ORDER BY SUM(TotalAmount) DESC, Description LIMIT 10""",
)
add(
    "top_countries",
    lambda t: marts.top_countries(t.sales, 10),
    """SELECT Country, CAST(TotalSales AS DOUBLE) AS TotalSales FROM country_sales
       ORDER BY TotalSales DESC, Country LIMIT 10""",
)

# ------------------------------------------------------------------- anomalies


def _flagged(t):
    return anomalies.anomalies(t.sales, threshold=1.5, severity=(1.3, 1.1, 0.9))


SCORES = ["anomaly_score", "qty_zscore", "price_zscore", "amount_zscore"]

add(
    "column_stats",
    lambda t: rounded(
        anomalies.column_stats(t.sales),
        6,
        *[f"{kind}_{name}" for name in anomalies.MEASURES for kind in ("mean", "std")],
    ),
    """SELECT ROUND(mean_qty, 6) AS mean_qty, ROUND(std_qty, 6) AS std_qty, ROUND(mean_price, 6) AS mean_price,
              ROUND(std_price, 6) AS std_price, ROUND(mean_amount, 6) AS mean_amount,
              ROUND(std_amount, 6) AS std_amount FROM stats""",
)
add(
    "broadcast_stats",
    lambda t: rounded(
        anomalies.with_z_scores(t.sales).select("InvoiceNo", "StockCode", "Quantity", *SCORES[1:]),
        6,
        *SCORES[1:],
    ),
    """SELECT InvoiceNo, StockCode, Quantity, ROUND(qty_zscore, 6) AS qty_zscore,
              ROUND(price_zscore, 6) AS price_zscore, ROUND(amount_zscore, 6) AS amount_zscore FROM z""",
)
add(
    "anomalies",
    lambda t: rounded(_flagged(t), 6, *SCORES),
    """SELECT InvoiceNo, CustomerID, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
              CAST(TotalAmount AS DOUBLE) AS TotalAmount, InvoiceDate, Country, is_anomaly, anomaly_type,
              ROUND(anomaly_score, 6) AS anomaly_score, severity, ROUND(qty_zscore, 6) AS qty_zscore,
              ROUND(price_zscore, 6) AS price_zscore, ROUND(amount_zscore, 6) AS amount_zscore FROM flagged""",
)
add(
    "anomaly_summary",
    lambda t: rounded(anomalies.anomaly_summary(_flagged(t)), 6, "avg_score"),
    """SELECT severity, COUNT(*) AS anomaly_count, ROUND(AVG(anomaly_score), 6) AS avg_score,
              CAST(SUM(TotalAmount) AS DOUBLE) AS total_amount FROM flagged GROUP BY severity""",
)
add(
    "custom_order",
    lambda t: anomalies.anomaly_summary(_flagged(t)).select(
        "severity", "anomaly_count", position_in("severity", anomalies.SEVERITIES[:3]).alias("priority")
    ),
    """SELECT severity, COUNT(*) AS anomaly_count,
              CAST(CASE severity WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END
                AS INTEGER) AS priority FROM flagged GROUP BY severity ORDER BY priority""",
)
add(
    "anomaly_rate",
    lambda t: anomalies.anomaly_rate(_flagged(t)),
    """SELECT COUNT(*) AS total_transactions, CAST(SUM(is_anomaly) AS BIGINT) AS anomalies,
              CAST(SUM(is_anomaly) AS DOUBLE) / COUNT(*) * 100 AS anomaly_rate FROM flagged""",
)
add(
    "distribution",
    lambda t: reports.distribution(_flagged(t).where("is_anomaly = 1"), "anomaly_type"),
    "SELECT anomaly_type, COUNT(*) AS count FROM flagged WHERE is_anomaly = 1 GROUP BY anomaly_type",
)
add(
    "top_anomalies",
    lambda t: rounded(
        anomalies.top_anomalies(_flagged(t), ("Critical", "High"), 20).select(
            "InvoiceNo", "StockCode", "Quantity", "TotalAmount", "anomaly_score", "severity"
        ),
        6,
        "anomaly_score",
    ),
    """SELECT InvoiceNo, StockCode, Quantity, CAST(TotalAmount AS DOUBLE) AS TotalAmount,
              ROUND(anomaly_score, 6) AS anomaly_score, severity
       FROM flagged WHERE severity IN ('Critical', 'High')
       ORDER BY flagged.anomaly_score DESC, InvoiceNo, StockCode, Quantity, flagged.TotalAmount LIMIT 20""",
)

# ---------------------------------------------------------------------- series

add(
    "revenue_lags",
    lambda t: series.add_lags(marts.monthly_summary(t.sales), forecast.LAGS).select(
        "year", "month", "total_revenue", *forecast.LAGS
    ),
    """SELECT year, month, CAST(total_revenue AS DOUBLE) AS total_revenue,
              CAST(LAG(total_revenue, 1) OVER w AS DOUBLE) AS revenue_lag1,
              CAST(LAG(total_revenue, 2) OVER w AS DOUBLE) AS revenue_lag2,
              CAST(LAG(total_revenue, 3) OVER w AS DOUBLE) AS revenue_lag3,
              LAG(total_orders, 1) OVER w AS orders_lag1, LAG(unique_customers, 1) OVER w AS customers_lag1
       FROM month_summary WINDOW w AS (ORDER BY year, month)""",
)

_FRAME_SQL = """
    SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales, {value} AS {name}
    FROM (SELECT *, CAST(SUM(MonthlySales) OVER w AS DOUBLE) AS s, COUNT(MonthlySales) OVER w AS n FROM months
          WINDOW w AS (ORDER BY Year, Month ROWS BETWEEN {frame}))"""


def _frame(t, *args, **kwargs):
    return series.moving_avg(
        marts.monthly_sales(t.sales), "MonthlySales", *args, order=YEAR_MONTH, **kwargs
    )


add(
    "moving_avg_3m",
    lambda t: _frame(t, "moving_avg_3m", -2, 0),
    _FRAME_SQL.format(value="s / n", name="moving_avg_3m", frame="2 PRECEDING AND CURRENT ROW"),
)
add(
    "moving_avg_3m_full",
    lambda t: _frame(t, "moving_avg_3m", -2, 0, full=True),
    _FRAME_SQL.format(
        value="CASE WHEN n = 3 THEN s / n END", name="moving_avg_3m", frame="2 PRECEDING AND CURRENT ROW"
    ),
)
add(
    "avg_prev_2m",
    lambda t: _frame(t, "AvgPrevSales", -2, -1).na.fill(0.0, ["AvgPrevSales"]),
    _FRAME_SQL.format(
        value="CASE WHEN n = 0 THEN CAST(0 AS DOUBLE) ELSE s / n END",
        name="AvgPrevSales",
        frame="2 PRECEDING AND 1 PRECEDING",
    ),
)
add(
    "month_index",
    lambda t: series.with_position(marts.monthly_sales(t.sales), "Month_Index", YEAR_MONTH).select(
        "Year", "Month", "Month_Index", series.month_number().alias("MonthIndex")
    ),
    """SELECT Year, Month, CAST(ROW_NUMBER() OVER (ORDER BY Year, Month) - 1 AS INTEGER) AS Month_Index,
              CAST((Year - 2010) * 12 + Month AS INTEGER) AS MonthIndex FROM months""",
)
add(
    "last_n_months",
    lambda t: series.last_months(marts.monthly_sales(t.sales), 12, YEAR_MONTH),
    """SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales FROM months
       ORDER BY Year DESC, Month DESC LIMIT 12""",
)
add(
    "month_growth",
    lambda t: rounded(
        series.month_growth(marts.monthly_sales(t.sales), "MonthlySales", 6, YEAR_MONTH), 6, "growth_pct"
    ),
    """SELECT ROUND(CAST(SUM(step) AS DOUBLE) / COUNT(step) / (CAST(SUM(v) AS DOUBLE) / COUNT(v)) * 100, 6)
              AS growth_pct
       FROM (SELECT MonthlySales AS v, MonthlySales - LAG(MonthlySales) OVER (ORDER BY Year, Month) AS step
             FROM (SELECT * FROM months ORDER BY Year DESC, Month DESC LIMIT 6))""",
)
add(
    "last_row",
    lambda t: series.last_row(marts.monthly_sales(t.sales), YEAR_MONTH),
    """SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales FROM months
       ORDER BY Year DESC, Month DESC LIMIT 1""",
)
add(
    "trend_slope",
    lambda t: rounded(
        series.trend_slope(marts.monthly_sales(t.sales), "MonthlySales", 6, YEAR_MONTH), 4, "slope"
    ),
    """SELECT ROUND(regr_slope(CAST(MonthlySales AS DOUBLE), CAST(x AS DOUBLE)), 4) AS slope
       FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY Year, Month) - 1 AS x FROM months
             ORDER BY Year DESC, Month DESC LIMIT 6)""",
)
add(
    "future_calendar",
    lambda t: series.future_days(marts.daily_summary(t.sales), 90),
    """SELECT CAST((SELECT MAX(CAST(InvoiceDate AS DATE)) FROM sales) + to_days(CAST(i AS INTEGER)) AS DATE) AS Date
       FROM range(1, 91) r(i)""",
)
add(
    "eval_mape_rmse_mae",
    lambda t: rounded(
        evaluation.mape_rmse_mae(_frame(t, "guess", -2, -1), "MonthlySales", "guess"),
        4,
        "mape",
        "rmse",
        "mae",
        "model_accuracy",
    ),
    """SELECT ROUND(AVG(ABS(a - g) / a) * 100, 4) AS mape, ROUND(SQRT(AVG(pow(a - g, 2))), 4) AS rmse,
              ROUND(AVG(ABS(a - g)), 4) AS mae, ROUND(100 - AVG(ABS(a - g) / a) * 100, 4) AS model_accuracy
       FROM (SELECT CAST(MonthlySales AS DOUBLE) AS a,
                    CAST(SUM(MonthlySales) OVER w AS DOUBLE) / NULLIF(COUNT(MonthlySales) OVER w, 0) AS g
             FROM months WINDOW w AS (ORDER BY Year, Month ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING))
       WHERE g IS NOT NULL""",
)
