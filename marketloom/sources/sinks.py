"""Catalog tables and file sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from marketloom.sources.readers import read_invoices_csv

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables() if not t.isTemporary)


def drop_tables(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def append_raw(spark: SparkSession, path: str, table: str = "ecommerce_raw") -> None:
    """Add a landed file to the raw table."""
    read_invoices_csv(spark, path).write.mode("append").format("parquet").saveAsTable(table)


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table. Partition only by columns with few values, such as Year and Month."""
    if partition_by:
        # Rows of a partition go to few files, and a hot partition is split over several tasks.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def replace_partitions(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that the rows belong to, and leave the others as they are.

    Doing it again gives the same table, and readers see the table all the time.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        write_table(df, name, partition_by)
        return
    rows = df.select(*spark.table(name).columns).hint("rebalance", *partition_by)
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        rows.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def ctas_from_view(df: DataFrame, name: str) -> None:
    """Register a view and create the table from it with SQL."""
    spark = df.sparkSession
    view = f"{name}_source"
    df.createOrReplaceTempView(view)
    drop_tables(spark, name)
    spark.sql(f"CREATE TABLE `{name}` USING parquet AS SELECT * FROM `{view}`")
    spark.catalog.dropTempView(view)


def write_empty_table(spark: SparkSession, name: str, ddl: str) -> None:
    write_table(spark.createDataFrame([], ddl), name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per task; quotes inside a field are doubled, as the reader expects."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
