"""The star-schema sample tables seen as one flat invoice-line table."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import cleaning
from marketloom.sources.schemas import MONEY, SAMPLE_TABLES


def sample_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SAMPLE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def invoices(spark: SparkSession, sf_dir: str, sold: bool = False, known: bool = False) -> DataFrame:
    """Raw invoice columns. Returned lines get a negative quantity, pending orders have no customer.

    ``sold`` and ``known`` leave out returned lines and lines without customer by conditions on the sample
    columns, which reach the scans; conditions on the derived columns would not.

    No join carries a hint: the planner broadcasts a side only when its size is under the session's
    limit, and sorts or splits skewed keys otherwise.
    """

    def table(name: str) -> DataFrame:
        return sample_table(spark, sf_dir, name)

    buyers = table("customer").join(
        table("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "n_name")
    placed, items = table("orders"), table("lineitem")
    if sold:
        flag, size = F.col("l_returnflag"), F.col("l_quantity")
        items = items.where(((size > 0) & (flag.isNull() | (flag != "R"))) | ((size < 0) & (flag == "R")))
    if known:
        placed = placed.where((F.col("o_orderstatus") != "P") & F.col("o_custkey").isNotNull())
    orders = placed.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    of_part, of_order = F.col("l_partkey") == F.col("p_partkey"), F.col("l_orderkey") == F.col("o_orderkey")
    if known:
        # Lines without customer leave before the products are joined on.
        lines = items.join(orders, of_order).join(table("part"), of_part)
    else:
        lines = items.join(table("part"), of_part).join(orders, of_order)
    quantity = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string"))
    return lines.select(
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        quantity.cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("p_retailprice").cast(MONEY).alias("UnitPrice"),
        customer.alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


class Tables:
    """The inputs the catalogue's queries read, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def invoices(self) -> DataFrame:
        return invoices(self.spark, self.sf_dir)

    @cached_property
    def lines(self) -> DataFrame:
        return cleaning.add_line_columns(self.invoices)

    @cached_property
    def sales(self) -> DataFrame:
        return cleaning.valid_sales(cleaning.add_line_columns(invoices(self.spark, self.sf_dir, sold=True)))

    @cached_property
    def customer_sales(self) -> DataFrame:
        lines = invoices(self.spark, self.sf_dir, sold=True, known=True)
        return cleaning.valid_customer_sales(cleaning.add_line_columns(lines))

    @cached_property
    def events(self) -> DataFrame:
        return sample_table(self.spark, self.sf_dir, "events")
