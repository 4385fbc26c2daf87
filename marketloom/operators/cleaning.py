"""Parsing, derived line columns and row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions.columns import finite_or_zero
from marketloom.sources.schemas import MONEY


def parse_invoice_date(df: DataFrame, fmt: str = "M/d/yyyy H:mm", column: str = "InvoiceDate") -> DataFrame:
    """Text to timestamp; text that does not fit becomes NULL."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column), F.lit(fmt)))


def total_amount(quantity: str = "Quantity", price: str = "UnitPrice") -> Column:
    return (F.col(quantity) * F.col(price)).cast(MONEY)


def add_line_columns(lines: DataFrame) -> DataFrame:
    """Month, Year and TotalAmount of a line with a parsed date."""
    return lines.withColumns(
        {
            "Month": F.month("InvoiceDate"),
            "Year": F.year("InvoiceDate"),
            "TotalAmount": total_amount(),
        }
    )


def valid_sales(lines: DataFrame) -> DataFrame:
    """Sold lines: no returns, no free items."""
    return lines.where((F.col("Quantity") > 0) & (F.col("UnitPrice") > 0))


def valid_customer_sales(lines: DataFrame) -> DataFrame:
    """Sold lines of known customers."""
    return valid_sales(lines).where((F.col("TotalAmount") > 0) & F.col("CustomerID").isNotNull())


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def filter_sales(
    df: DataFrame,
    countries: Sequence[str] = (),
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Country list and day range, both ends included; an empty choice does not filter.

    The years of the range are named too, which prunes folders where the lines are stored by year.
    """
    if "Year" in df.columns:
        if start is not None:
            df = df.where(F.col("Year") >= start.year)
        if end is not None:
            df = df.where(F.col("Year") <= end.year)
    if countries:
        df = df.where(F.col("Country").isin(list(countries)))
    if start is not None:
        df = df.where(F.col("InvoiceDate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        after = end + dt.timedelta(days=1)
        df = df.where(F.col("InvoiceDate") < F.lit(after).cast("timestamp_ntz"))
    return df


def cut_date(df: DataFrame, days: int = 30) -> Column:
    """Newest invoice date minus some days, as a one-value subquery."""
    return df.agg((F.max("InvoiceDate") - F.make_interval(days=F.lit(days))).alias("cut")).scalar()


def time_split(df: DataFrame, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """History before the cut date and observation from it on."""
    cut = cut_date(df, days)
    return df.where(F.col("InvoiceDate") < cut), df.where(F.col("InvoiceDate") >= cut)


def fill_missing(df: DataFrame, *columns: str) -> DataFrame:
    """NULL, NaN and infinities as 0."""
    return df.withColumns({name: finite_or_zero(name) for name in columns})
