"""Sales marts and dashboard figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import WEEKDAYS, money_mean, ratio, year_month
from marketloom.operators.reports import top_n


def sales_per_country(sales: DataFrame) -> DataFrame:
    return sales.groupBy("Country").agg(F.sum("TotalAmount").alias("TotalSales"))


def monthly_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("Year", "Month").agg(F.sum("TotalAmount").alias("MonthlySales"))


def customer_metrics(sales: DataFrame) -> DataFrame:
    """Spend and number of lines per customer; lines without a customer form one group."""
    return sales.groupBy("CustomerID").agg(
        F.sum("TotalAmount").alias("TotalPurchases"),
        F.count("InvoiceNo").alias("NumberOfTransactions"),
    )


def product_performance(sales: DataFrame) -> DataFrame:
    return sales.groupBy("StockCode", "Description").agg(
        F.sum("Quantity").alias("TotalQuantitySold"),
        F.sum("TotalAmount").alias("TotalRevenue"),
    )


def monthly_summary(sales: DataFrame) -> DataFrame:
    """The series the monthly forecasts read.

    The distinct counts are planned on (month, value), so a hot month is spread over many tasks.
    """
    return (
        sales.where(F.col("TotalAmount") > 0)
        .groupBy(F.col("Year").alias("year"), F.col("Month").alias("month"))
        .agg(
            F.sum("TotalAmount").alias("total_revenue"),
            F.count_distinct("CustomerID").alias("unique_customers"),
            F.count_distinct("InvoiceNo").alias("total_orders"),
            money_mean("TotalAmount").alias("avg_order_value"),
            F.sum("Quantity").alias("total_items_sold"),
        )
    )


def daily_summary(sales: DataFrame) -> DataFrame:
    return (
        sales.where(F.col("TotalAmount") > 0)
        .groupBy(F.to_date("InvoiceDate").alias("Date"))
        .agg(
            F.sum("TotalAmount").alias("Revenue"),
            F.count(F.lit(1)).alias("Orders"),
            money_mean("TotalAmount").alias("AvgOrderValue"),
            F.count_distinct("CustomerID").alias("UniqueCustomers"),
            F.sum("Quantity").alias("ItemsSold"),
        )
    )


def kpi_overview(customer_sales: DataFrame) -> DataFrame:
    return customer_sales.agg(
        F.sum("TotalAmount").alias("TotalRevenue"),
        F.count_distinct("InvoiceNo").alias("TotalOrders"),
        F.count_distinct("CustomerID").alias("UniqueCustomers"),
        F.count_distinct("Description").alias("UniqueProducts"),
    ).withColumn("AvgOrderValue", ratio("TotalRevenue", "TotalOrders"))


def kpi_totals(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("TotalTransactions"),
        F.sum("Quantity").alias("TotalQuantity"),
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("TotalRevenue"),
    )


def daily_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.to_date("InvoiceDate").alias("Date")).agg(F.sum("TotalAmount").alias("Revenue"))


def year_month_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy(year_month("InvoiceDate").alias("YearMonth")).agg(
        F.sum("TotalAmount").alias("Revenue")
    )


def yearly_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("Year").agg(F.sum("TotalAmount").alias("Revenue"))


def revenue_by_day_of_week(sales: DataFrame) -> DataFrame:
    """All seven days, Monday first; a day without sales keeps a NULL."""
    totals = sales.groupBy(F.date_format("InvoiceDate", "EEEE").alias("DayOfWeek")).agg(
        F.sum("TotalAmount").alias("Revenue")
    )
    days = sales.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, WEEKDAYS))).alias("DayIndex", "DayOfWeek")
    )
    return days.join(totals, "DayOfWeek", "left").select("DayIndex", "DayOfWeek", "Revenue")


def revenue_by_hour(df: DataFrame, ts: str = "InvoiceDate", amount: str = "TotalAmount") -> DataFrame:
    return df.groupBy(F.hour(ts).alias("Hour")).agg(F.sum(amount).alias("Revenue"))


def customers_by_country(customer_sales: DataFrame, n: int = 10) -> DataFrame:
    counts = customer_sales.groupBy("Country").agg(F.count_distinct("CustomerID").alias("Customers"))
    return top_n(counts, "Customers", ["Country"], n)


def top_countries(sales: DataFrame, n: int = 10) -> DataFrame:
    return top_n(sales_per_country(sales), "TotalSales", ["Country"], n)


def top_products_by_quantity(sales: DataFrame, n: int = 10) -> DataFrame:
    totals = sales.groupBy("Description").agg(F.sum("Quantity").alias("TotalQuantity"))
    return top_n(totals, "TotalQuantity", ["Description"], n)


def top_products_by_revenue(sales: DataFrame, n: int = 10) -> DataFrame:
    totals = sales.groupBy("Description").agg(F.sum("TotalAmount").alias("TotalRevenue"))
    return top_n(totals, "TotalRevenue", ["Description"], n)


def customer_order_features(customer_sales: DataFrame) -> DataFrame:
    """Spend, orders and items per customer: the clustering input."""
    return customer_sales.groupBy("CustomerID").agg(
        F.sum("TotalAmount").alias("TotalSpending"),
        F.count_distinct("InvoiceNo").alias("TotalOrders"),
        F.sum("Quantity").alias("TotalItems"),
    ).withColumn("AvgOrderValue", ratio("TotalSpending", "TotalOrders"))


def distinct_products(sales: DataFrame) -> DataFrame:
    return (
        sales.where(F.col("StockCode").isNotNull() & F.col("Description").isNotNull())
        .select("StockCode", "Description")
        .distinct()
    )


def product_info(sales: DataFrame) -> DataFrame:
    """One description and price (of the earliest sale, ties by name) and the average price per product.

    Sales are first reduced to product versions with numeric aggregates, which hash; picking the text of
    the earliest version sorts, but only the few versions of a product.
    """
    versions = (
        sales.where(F.col("Description").isNotNull())
        .groupBy("StockCode", "Description", "UnitPrice")
        .agg(F.min("InvoiceDate").alias("_first"), F.count(F.lit(1)).alias("_n"))
    )
    earliest = F.struct("_first", "Description", "UnitPrice")
    return versions.groupBy("StockCode").agg(
        F.min_by("Description", earliest).alias("Description"),
        F.min_by("UnitPrice", earliest).alias("FirstPrice"),
        ratio(F.sum(F.col("UnitPrice") * F.col("_n")), F.sum("_n")).alias("AveragePrice"),
    )


def quantity_per_customer_item(sales: DataFrame) -> DataFrame:
    """Aggregation given as a column-to-function mapping."""
    return (
        sales.groupBy("CustomerID", "StockCode")
        .agg({"Quantity": "sum"})
        .withColumnRenamed("sum(Quantity)", "TotalQuantity")
    )
