"""Sinks and the landing stream: rows written to the shared folder or the catalog, and what is read back.

Files go with ``drop_stored``; tables are dropped once their rows are stored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.operators import marts
from marketloom.plans.catalog import add
from marketloom.session import new_folder, stored
from marketloom.sources import readers, sinks
from marketloom.sources.samples import Tables
from marketloom.streaming.landing import landing_stream


def _through_table(spark: SparkSession, write: Callable[[str], None]) -> DataFrame:
    """The rows of a table that ``write`` makes under the name it is given; the table is dropped."""
    name = f"round_trip_{uuid.uuid4().hex}"
    try:
        write(name)
        return stored(spark.table(name))
    finally:
        sinks.drop_tables(spark, name)


# ------------------------------------------------------------------- files and tables


def _as_text(t: Tables) -> DataFrame:
    """Invoice lines as a file has them: dates as text, descriptions with a comma and quotes."""
    return t.invoices.withColumns(
        {
            "Description": F.concat("Description", F.lit(', "each"')),
            "InvoiceDate": F.date_format("InvoiceDate", "yyyy-MM-dd HH:mm:ss"),
        }
    )


def _csv_round_trip(t: Tables) -> DataFrame:
    folder = new_folder(t.spark)
    sinks.write_csv(_as_text(t), folder)
    return readers.read_invoices_csv(t.spark, folder).groupBy("Country").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("Quantity").alias("quantity"),
        F.count("CustomerID").alias("n_known"),
        F.countDistinct("Description").alias("n_products"),
        F.min("Description").alias("first_product"),
        F.max("InvoiceDate").alias("newest"),
    )


add(
    "csv_round_trip",
    _csv_round_trip,
    """SELECT Country, COUNT(*) AS n_lines, CAST(SUM(Quantity) AS BIGINT) AS quantity, COUNT(CustomerID) AS n_known,
              COUNT(DISTINCT Description) AS n_products, MIN(Description || ', "each"') AS first_product,
              strftime(MAX(InvoiceDate), '%Y-%m-%d %H:%M:%S') AS newest
       FROM invoices GROUP BY Country""",
)


def _appended_files(t: Tables) -> DataFrame:
    """Two landed files, one after the other."""
    returned = F.coalesce(F.col("Quantity") < 0, F.lit(False))

    def write(name: str) -> None:
        for part in (returned, ~returned):
            folder = new_folder(t.spark)
            sinks.write_csv(_as_text(t).where(part), folder)
            sinks.append_raw(t.spark, folder, name)

    rows = _through_table(t.spark, write)
    return rows.groupBy("Country").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("Quantity") < 0).alias("n_returned"))


add(
    "append_raw",
    _appended_files,
    """SELECT Country, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE Quantity < 0) AS n_returned
       FROM invoices GROUP BY Country""",
)
add(
    "write_partitioned",
    lambda t: _through_table(
        t.spark, lambda name: sinks.write_table(marts.monthly_sales(t.sales), name, ["Year", "Month"])
    ).select("Year", "Month", "MonthlySales"),
    "SELECT Year, Month, CAST(MonthlySales AS DOUBLE) AS MonthlySales FROM months",
)
add(
    "ctas_from_view",
    lambda t: _through_table(t.spark, lambda name: sinks.ctas_from_view(marts.sales_per_country(t.sales), name)).select(
        "Country", "TotalSales"
    ),
    "SELECT Country, CAST(TotalSales AS DOUBLE) AS TotalSales FROM country_sales",
)


def _empty_typed(t: Tables) -> DataFrame:
    """An empty table with the types of the monthly sales takes their rows behind it."""
    months = marts.monthly_sales(t.sales)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in months.schema.fields)
    empty = _through_table(t.spark, lambda name: sinks.write_empty_table(t.spark, name, ddl))
    return readers.row_counts({"empty": empty, "with_months": empty.unionByName(months)})


add(
    "empty_typed_table",
    _empty_typed,
    """SELECT 'empty' AS table_name, CAST(0 AS BIGINT) AS row_count
       UNION ALL SELECT 'with_months', COUNT(*) FROM months""",
)

# --------------------------------------------------------------------- landing stream


def _land(events: DataFrame, folder: str) -> None:
    """Events as lines of text, the files of a type in a directory of its own."""
    line = F.concat_ws(",", "event_id", "user_id", "event_type").alias("value")
    events.select(line, "event_type").write.mode("append").partitionBy("event_type").text(folder)


def _drained(t: Tables, parts: list[DataFrame]) -> DataFrame:
    """The archive after every part has landed and been drained, and one drain more that finds nothing new."""
    landing, archive, state = (new_folder(t.spark) for _ in range(3))
    for part in [*parts, None]:
        if part is not None:
            _land(part, landing)
        landing_stream(t.spark, landing, archive, state, once=True).awaitTermination()
    return t.spark.read.parquet(archive)


def _landed_lines(t: Tables) -> DataFrame:
    seconds = F.unix_seconds(F.col("arrived_at")) - F.unix_seconds(F.col("arrived_bucket"))
    rows = _drained(t, [t.events]).withColumn("directory", F.regexp_extract("source_file", "event_type=([^/]+)", 1))
    return rows.groupBy("directory").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("value").alias("n_distinct"),
        F.count_if(F.element_at(F.split("value", ","), 3) != F.col("directory")).alias("n_elsewhere"),
        F.count_if((seconds < 0) | (seconds >= 600)).alias("n_off_bucket"),
        F.count_if(F.to_date("arrived_at") != F.col("arrived_date")).alias("n_off_date"),
    )


LINE_SQL = "CAST(event_id AS VARCHAR) || ',' || CAST(user_id AS VARCHAR) || ',' || event_type"
add(
    "landing_stream",
    _landed_lines,
    f"""SELECT event_type AS directory, COUNT(*) AS n_lines, COUNT(DISTINCT {LINE_SQL}) AS n_distinct,
               CAST(0 AS BIGINT) AS n_elsewhere, CAST(0 AS BIGINT) AS n_off_bucket, CAST(0 AS BIGINT) AS n_off_date
        FROM events GROUP BY event_type""",
)


def _landed_twice(t: Tables) -> DataFrame:
    early = F.col("event_id") % 3 == 0
    rows = _drained(t, [t.events.where(early), t.events.where(~early)])
    parts = F.split("value", ",")
    return rows.groupBy(F.element_at(parts, 3).alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.countDistinct("value").alias("n_distinct"),
        F.count_if(F.element_at(parts, 1).cast("bigint") % 3 == 0).alias("n_early"),
    )


add(
    "landing_stream_resumed",
    _landed_twice,
    f"""SELECT event_type, COUNT(*) AS n_lines, COUNT(DISTINCT {LINE_SQL}) AS n_distinct,
               COUNT(*) FILTER (WHERE event_id % 3 = 0) AS n_early
        FROM events GROUP BY event_type""",
)
