"""Sources, projections, filters and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketloom.functions import columns as c
from marketloom.operators import anomalies, churn, cleaning, marts, series
from marketloom.plans.catalog import add, rounded
from marketloom.sources.readers import row_counts, table_scan
from marketloom.streaming.landing import bucket_start

DATE_FORMAT = "M/d/yyyy H:mm"

# -------------------------------------------------------------------- sources

add(
    "table_scan",
    lambda t: table_scan(
        t.lines,
        ["InvoiceNo", "CustomerID", "StockCode", "Quantity", "UnitPrice", "TotalAmount", "InvoiceDate"],
        F.col("TotalAmount") > 0,
    ),
    """SELECT InvoiceNo, CustomerID, StockCode, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
              CAST(TotalAmount AS DOUBLE) AS TotalAmount, InvoiceDate
       FROM lines WHERE TotalAmount > 0""",
)
add(
    "row_counts",
    lambda t: row_counts(
        {
            "ecommerce_raw": t.invoices,
            "ecommerce_transformed": t.sales,
            "sales_per_country": marts.sales_per_country(t.sales),
            "monthly_sales": marts.monthly_sales(t.sales),
            "customer_metrics": marts.customer_metrics(t.sales),
            "product_performance": marts.product_performance(t.sales),
        }
    ),
    """SELECT 'ecommerce_raw' AS table_name, COUNT(*) AS row_count FROM invoices
       UNION ALL SELECT 'ecommerce_transformed', COUNT(*) FROM sales
       UNION ALL SELECT 'sales_per_country', COUNT(DISTINCT Country) FROM sales
       UNION ALL SELECT 'monthly_sales', COUNT(*) FROM months
       UNION ALL SELECT 'customer_metrics', COUNT(*) FROM (SELECT DISTINCT CustomerID FROM sales)
       UNION ALL SELECT 'product_performance', COUNT(*) FROM (SELECT DISTINCT StockCode, Description FROM sales)""",
)
add(
    "literal_rows",
    lambda t: series.future_months(marts.monthly_sales(t.sales))
    .withColumn("MonthIndex", series.month_number())
    .withColumn("Type", F.lit("Forecast")),
    """SELECT CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
              CAST((year(d) - 2010) * 12 + month(d) AS INTEGER) AS MonthIndex, 'Forecast' AS Type
       FROM (SELECT (SELECT MAX(make_date(Year, Month, 1)) FROM months) + to_months(CAST(i AS INTEGER)) AS d
             FROM range(1, 4) r(i))""",
)

# -------------------------------------------------------- projections, filters


def _raw_event_dates(t):
    """Event times as invoice text; error events carry text that is no date."""
    text = F.when(F.col("event_type") == "error", F.lit("zz")).otherwise(F.date_format("ts", DATE_FORMAT))
    return t.events.select("event_id", text.alias("InvoiceDate"))


add(
    "parse_invoice_date",
    lambda t: cleaning.parse_invoice_date(_raw_event_dates(t), DATE_FORMAT),
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('minute', ts) END
              AS InvoiceDate FROM events""",
)
add(
    "month_year",
    lambda t: t.lines.select("InvoiceNo", "StockCode", "InvoiceDate", "Month", "Year"),
    "SELECT InvoiceNo, StockCode, InvoiceDate, Month, Year FROM lines",
)
add(
    "total_amount",
    lambda t: t.lines.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice", "TotalAmount"),
    """SELECT InvoiceNo, StockCode, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
              CAST(TotalAmount AS DOUBLE) AS TotalAmount FROM lines""",
)
add(
    "valid_sales",
    lambda t: t.sales,
    """SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalAmount AS DOUBLE) AS TotalAmount)
       FROM sales""",
)
add(
    "valid_customer_sales",
    lambda t: t.customer_sales,
    """SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalAmount AS DOUBLE) AS TotalAmount)
       FROM cust_sales""",
)


def _guard_counts(t):
    """Rows each job's guard lets through."""
    jobs = {
        "market_basket": cleaning.require(t.sales, "Description", "InvoiceNo"),
        "product_recommendations": cleaning.require(t.sales, "CustomerID", "StockCode"),
        "rfm_analysis": cleaning.require(t.sales, "CustomerID", "InvoiceDate").where("TotalAmount > 0"),
        "churn_prediction": cleaning.require(t.sales, "CustomerID"),
        "anomaly_detection": t.sales.where("TotalAmount > 0"),
        "neighbour_recommendations": cleaning.require(t.customer_sales, "Description"),
    }
    return row_counts(jobs)


add(
    "non_null_scans",
    _guard_counts,
    """SELECT 'market_basket' AS table_name, COUNT(*) AS row_count FROM sales
         WHERE Description IS NOT NULL AND InvoiceNo IS NOT NULL
       UNION ALL SELECT 'product_recommendations', COUNT(*) FROM sales
         WHERE CustomerID IS NOT NULL AND StockCode IS NOT NULL
       UNION ALL SELECT 'rfm_analysis', COUNT(*) FROM sales
         WHERE CustomerID IS NOT NULL AND InvoiceDate IS NOT NULL AND TotalAmount > 0
       UNION ALL SELECT 'churn_prediction', COUNT(*) FROM sales WHERE CustomerID IS NOT NULL
       UNION ALL SELECT 'anomaly_detection', COUNT(*) FROM sales WHERE TotalAmount > 0
       UNION ALL SELECT 'neighbour_recommendations', COUNT(*) FROM cust_sales WHERE Description IS NOT NULL""",
)
add(
    "interactive_filter",
    lambda t: marts.sales_per_country(
        cleaning.filter_sales(
            t.customer_sales,
            ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_5"],
            dt.date(1997, 3, 1),
            dt.date(1999, 12, 31),
        )
    ),
    """SELECT Country, CAST(SUM(TotalAmount) AS DOUBLE) AS TotalSales FROM cust_sales
       WHERE Country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5')
         AND CAST(InvoiceDate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1999-12-31' GROUP BY Country""",
)
add(
    "bucket_ladder",
    lambda t: t.sales.select(
        "InvoiceNo",
        "StockCode",
        "Quantity",
        c.at_least("Quantity", [50, 20, 10, 5], [5, 4, 3, 2], 1).alias("rating"),
        c.at_least("TotalAmount", [50000, 20000, 5000], ["Critical", "High", "Medium"], "Low").alias("size"),
    ),
    """SELECT InvoiceNo, StockCode, Quantity,
              CAST(CASE WHEN Quantity >= 50 THEN 5 WHEN Quantity >= 20 THEN 4 WHEN Quantity >= 10 THEN 3
                   WHEN Quantity >= 5 THEN 2 ELSE 1 END AS INTEGER) AS rating,
              CASE WHEN TotalAmount >= 50000 THEN 'Critical' WHEN TotalAmount >= 20000 THEN 'High'
                   WHEN TotalAmount >= 5000 THEN 'Medium' ELSE 'Low' END AS size FROM sales""",
)


def _returns_ratio(t):
    """Amount per sold unit and customer: NULL without sales, a quotient by zero where all came back."""
    by = t.lines.groupBy("CustomerID").agg(
        F.sum("TotalAmount").cast("double").alias("Amount"),
        F.sum(F.when(F.col("Quantity") > 0, F.col("Quantity"))).cast("double").alias("Sold"),
    )
    quotient = F.when(F.col("Sold").isNull(), F.lit(float("inf"))).otherwise(F.col("Amount") / F.col("Sold"))
    return cleaning.fill_missing(by.withColumn("Ratio", quotient), "Sold", "Ratio")


add(
    "fill_missing",
    _returns_ratio,
    """SELECT CustomerID, CAST(SUM(TotalAmount) AS DOUBLE) AS Amount,
              COALESCE(CAST(SUM(CASE WHEN Quantity > 0 THEN Quantity END) AS DOUBLE), 0) AS Sold,
              COALESCE(CAST(SUM(TotalAmount) AS DOUBLE)
                / CAST(SUM(CASE WHEN Quantity > 0 THEN Quantity END) AS DOUBLE), 0) AS Ratio
       FROM lines GROUP BY CustomerID""",
)
add(
    "rename_cast",
    lambda t: t.customer_sales.select(
        F.expr("try_cast(CustomerID AS INT)").alias("customer_number"), "StockCode", "Quantity"
    )
    .groupBy("customer_number")
    .agg(F.sum("Quantity").alias("sum_quantity"))
    .withColumnRenamed("sum_quantity", "TotalQuantity"),
    """SELECT TRY_CAST(CustomerID AS INTEGER) AS customer_number, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantity
       FROM cust_sales GROUP BY 1""",
)
add(
    "literal_column",
    lambda t: marts.monthly_sales(t.sales).select(
        "Year",
        "Month",
        "MonthlySales",
        F.lit(None).cast("double").alias("PredictedSales"),
        F.lit("Historical").alias("Type"),
    ),
    """SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales,
              CAST(NULL AS DOUBLE) AS PredictedSales, 'Historical' AS Type FROM months""",
)


def _split_counts(t):
    history, observation = cleaning.time_split(t.customer_sales, 30)

    def summary(name, df):
        return df.agg(
            F.lit(name).alias("part"),
            F.count(F.lit(1)).alias("line_count"),
            F.count_distinct("CustomerID").alias("customers"),
            F.min("InvoiceDate").alias("first_date"),
            F.max("InvoiceDate").alias("last_date"),
        )

    return summary("history", history).unionByName(summary("observation", observation))


add(
    "time_split",
    _split_counts,
    """SELECT 'history' AS part, COUNT(*) AS line_count, COUNT(DISTINCT CustomerID) AS customers,
              MIN(InvoiceDate) AS first_date, MAX(InvoiceDate) AS last_date FROM history
       UNION ALL SELECT 'observation', COUNT(*), COUNT(DISTINCT CustomerID), MIN(InvoiceDate), MAX(InvoiceDate)
       FROM observation""",
)
add(
    "severity_filter",
    lambda t: rounded(
        anomalies.with_severity(
            anomalies.anomalies(t.sales, threshold=1.5, severity=(1.3, 1.1, 0.9)), ("Critical", "High")
        ).select(
            "InvoiceNo",
            "InvoiceDate",
            "CustomerID",
            "Quantity",
            "UnitPrice",
            "TotalAmount",
            "anomaly_score",
            "severity",
        ),
        6,
        "anomaly_score",
    ),
    """SELECT InvoiceNo, InvoiceDate, CustomerID, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
              CAST(TotalAmount AS DOUBLE) AS TotalAmount, ROUND(anomaly_score, 6) AS anomaly_score, severity
       FROM flagged WHERE severity IN ('Critical', 'High')""",
)

# ------------------------------------------------------------ scalar functions

add(
    "fn_date_parts",
    lambda t: t.events.select(
        "event_id",
        F.month("ts").alias("month"),
        F.year("ts").alias("year"),
        F.hour("ts").alias("hour"),
        F.date_format("ts", "EEEE").alias("day_name"),
        F.to_date("ts").alias("date"),
        c.year_month("ts").alias("year_month"),
    ),
    """SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(year(ts) AS INTEGER) AS year,
              CAST(hour(ts) AS INTEGER) AS hour, dayname(ts) AS day_name, CAST(ts AS DATE) AS date,
              strftime(ts, '%Y-%m') AS year_month FROM events""",
)


def _newest_event(t):
    return t.events.agg(F.max("ts")).scalar()


add(
    "fn_datediff",
    lambda t: t.events.select("event_id", c.calendar_days("ts", _newest_event(t)).alias("days")),
    """SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), (SELECT CAST(MAX(ts) AS DATE) FROM events))
              AS INTEGER) AS days FROM events""",
)
add(
    "fn_elapsed_days",
    lambda t: t.events.select("event_id", c.elapsed_days("ts", _newest_event(t)).alias("days")),
    """SELECT event_id, CAST(date_sub('day', ts, (SELECT MAX(ts) FROM events)) AS INTEGER) AS days
       FROM events""",
)
add(
    "fn_add_period",
    lambda t: t.invoices.select("InvoiceNo", "InvoiceDate", F.to_date("InvoiceDate").alias("d"))
    .distinct()
    .select(
        "InvoiceNo",
        F.date_add("d", 1).alias("plus_1_day"),
        F.date_sub("d", 30).alias("minus_30_days"),
        F.date_sub("d", 90).alias("minus_90_days"),
        F.add_months("d", 3).alias("plus_3_months"),
        ((F.month("d") + 3 - 1) % 12 + 1).cast("int").alias("future_month"),
        (F.year("d") + F.floor((F.month("d") + 3 - 1) / 12)).cast("int").alias("future_year"),
    ),
    """SELECT InvoiceNo, CAST(d + INTERVAL 1 DAY AS DATE) AS plus_1_day,
              CAST(d - INTERVAL 30 DAY AS DATE) AS minus_30_days, CAST(d - INTERVAL 90 DAY AS DATE) AS minus_90_days,
              CAST(d + INTERVAL 3 MONTH AS DATE) AS plus_3_months,
              CAST((month(d) + 2) % 12 + 1 AS INTEGER) AS future_month,
              CAST(year(d) + (month(d) + 2) // 12 AS INTEGER) AS future_year
       FROM (SELECT DISTINCT InvoiceNo, CAST(InvoiceDate AS DATE) AS d FROM invoices)""",
)
add(
    "fn_year_month_label",
    lambda t: marts.monthly_sales(t.sales).select(
        c.year_month_label("Year", "Month").alias("label"), "MonthlySales"
    ),
    """SELECT printf('%d-%02d', Year, Month) AS label, CAST(MonthlySales AS DOUBLE) AS MonthlySales FROM months""",
)
add(
    "fn_first_word",
    lambda t: t.lines.groupBy(c.first_word("Description").alias("ProductCategory")).agg(
        F.count(F.lit(1)).alias("line_count")
    ),
    """SELECT COALESCE(regexp_extract(trim(Description), '^\\S+'), 'Unknown') AS ProductCategory,
              COUNT(*) AS line_count FROM lines GROUP BY 1""",
)
add(
    "fn_pair_label",
    lambda t: t.invoices.select("Description", "Country")
    .distinct()
    .select(c.pair_label("Description", "Country", 6).alias("pair"), "Description", "Country"),
    """SELECT DISTINCT concat(substr(Description, 1, 6), ' + ', substr(Country, 1, 6)) AS pair, Description, Country
       FROM invoices""",
)


def _country_share(t):
    totals = marts.sales_per_country(t.sales)
    whole = totals.agg(F.sum("TotalSales")).scalar()
    return totals.select("Country", c.percent_text(c.ratio("TotalSales", whole)).alias("share"))


add(
    "fn_pct_text",
    _country_share,
    """SELECT Country, printf('%.2f%%', CAST(TotalSales AS DOUBLE)
              / (SELECT CAST(SUM(TotalSales) AS DOUBLE) FROM country_sales) * 100) AS share FROM country_sales""",
)


def _errors(t):
    rows = series.moving_avg(
        marts.monthly_sales(t.sales), "MonthlySales", "guess", -2, -1, order=["Year", "Month"]
    )
    actual, guess = F.col("MonthlySales").cast("double"), F.col("guess")
    error = F.abs(actual - guess)
    return rows.select(
        "Year",
        "Month",
        F.round(error, 4).alias("abs_error"),
        F.round(F.try_divide(error, actual), 6).alias("pct_error"),
        F.round(F.pow(actual - guess, F.lit(2)), 0).alias("squared_error"),
        F.round(F.greatest(actual - guess, F.lit(0.0)), 4).alias("floored"),
    )


add(
    "fn_math",
    _errors,
    """SELECT Year, Month, ROUND(ABS(a - g), 4) AS abs_error, ROUND(ABS(a - g) / a, 6) AS pct_error,
              ROUND(pow(a - g, 2), 0) AS squared_error,
              CASE WHEN g IS NULL THEN 0 ELSE ROUND(GREATEST(a - g, 0), 4) END AS floored
       FROM (SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS a,
                    CAST(SUM(MonthlySales) OVER w AS DOUBLE) / NULLIF(COUNT(MonthlySales) OVER w, 0) AS g
             FROM months WINDOW w AS (ORDER BY Year, Month ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING))""",
)


def _array_facts(t):
    """Size, first and second element, and exploded struct fields of each customer's yearly totals."""
    yearly = t.customer_sales.groupBy("CustomerID", "Year").agg(F.sum("TotalAmount").alias("Revenue"))
    # One element per year of the calendar.
    packed = yearly.groupBy("CustomerID").agg(
        F.array_sort(F.collect_list(F.struct("Year", F.col("Revenue").cast("double").alias("Revenue")))).alias(
            "years"
        )
    )
    return packed.select(
        "CustomerID",
        F.size("years").alias("n_years"),
        F.get("years", F.lit(0))["Year"].alias("first_year"),
        F.get("years", F.lit(1))["Year"].alias("second_year"),
        F.explode("years").alias("y"),
    ).select(
        "CustomerID",
        "n_years",
        "first_year",
        "second_year",
        F.col("y.Year").alias("Year"),
        F.col("y.Revenue").alias("Revenue"),
    )


add(
    "fn_array",
    _array_facts,
    """SELECT CustomerID, CAST(COUNT(*) OVER c AS INTEGER) AS n_years,
              nth_value(Year, 1) OVER f AS first_year, nth_value(Year, 2) OVER f AS second_year,
              Year, CAST(Revenue AS DOUBLE) AS Revenue
       FROM (SELECT CustomerID, Year, SUM(TotalAmount) AS Revenue FROM cust_sales GROUP BY CustomerID, Year)
       WINDOW c AS (PARTITION BY CustomerID),
              f AS (PARTITION BY CustomerID ORDER BY Year ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
add(
    "fn_is_uk",
    lambda t: t.lines.groupBy("Country", (F.col("Country") == "NATION_0").cast("int").alias("IsUK")).agg(
        F.count(F.lit(1)).alias("line_count")
    ),
    """SELECT Country, CAST(CASE WHEN Country = 'NATION_0' THEN 1 ELSE 0 END AS INTEGER) AS IsUK,
              COUNT(*) AS line_count FROM lines GROUP BY 1, 2""",
)
add(
    "fn_percent_change",
    lambda t: series.add_lags(
        marts.monthly_sales(t.sales), {"Before": ("MonthlySales", 1)}, ["Year", "Month"]
    ).select("Year", "Month", F.round(c.percent_change("Before", "MonthlySales"), 6).alias("change_pct")),
    """SELECT Year, Month, ROUND((a - b) / b * 100, 6) AS change_pct
       FROM (SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS a,
                    CAST(LAG(MonthlySales) OVER (ORDER BY Year, Month) AS DOUBLE) AS b FROM months)""",
)

# ----------------------------------------------------------- stream, in batch

add(
    "bucket_10_min",
    lambda t: t.events.groupBy(bucket_start("ts").alias("bucket"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    ),
    """SELECT time_bucket(INTERVAL '10 minutes', ts) AS bucket, event_type, COUNT(*) AS events
       FROM events GROUP BY 1, 2""",
)
add(
    "active_customers",
    lambda t: churn.active_customers(*cleaning.time_split(t.customer_sales, 30)),
    """SELECT DISTINCT CustomerID FROM history
       WHERE CustomerID IN (SELECT CustomerID FROM observation)""",
)
