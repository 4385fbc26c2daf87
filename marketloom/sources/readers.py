"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.sources.schemas import RAW_INVOICES


def read_invoices_csv(
    spark: SparkSession, path: str, keep_corrupt: bool = False, encoding: str = "ISO-8859-1"
) -> DataFrame:
    """Raw invoice lines from delimited text with a header.

    Quotes are honoured, so a comma inside a description stays one field. A cell that does not fit its
    type becomes NULL; ``keep_corrupt`` adds the original line as ``_corrupt_record``.
    """
    schema = RAW_INVOICES
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
    )
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.csv(path)


def table_scan(df: DataFrame, columns: list[str], condition=None) -> DataFrame:
    """Projected, filtered read; both reach a Parquet scan."""
    if condition is not None:
        df = df.where(condition)
    return df.select(*columns)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    report = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        report = part if report is None else report.unionByName(part)
    return report
