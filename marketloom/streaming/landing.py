"""Files dropped into a directory, copied to a dated archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def bucket_start(ts: Column | str, minutes: int = 10) -> Column:
    """Timestamp rounded down to a multiple of some minutes within the hour."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    width = 60 * minutes
    seconds = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(width)))


def read_landing(spark: SparkSession, src: str, minutes: int = 10, max_bytes: int = 0) -> DataFrame:
    """One row per line of a landed file, with arrival time, rounded time and the file it came from.

    With ``max_bytes`` a batch takes files up to that size (one file at least).
    """
    reader = spark.readStream.format("text")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    lines = reader.load(src)
    arrived = F.current_timestamp()
    return lines.select(
        "value",
        arrived.alias("arrived_at"),
        bucket_start(arrived, minutes).alias("arrived_bucket"),
        F.to_date(arrived).alias("arrived_date"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def landing_stream(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    minutes: int = 10,
    max_records: int = 1_000_000,
    max_bytes: int = 128 << 20,
    roll: str = "30 minutes",
    once: bool = False,
    as_text: bool = False,
) -> StreamingQuery:
    """Copy every landed file exactly once into files that roll by number of lines, size and time.

    A file holds at most ``max_records`` lines and, as a batch takes no more than ``max_bytes`` of landed files
    (or one file), about that many bytes; ``roll`` is the time between batches.

    ``as_text`` writes the lines alone; otherwise Parquet keeps the arrival columns. Both are partitioned
    by arrival date. ``once`` drains what is there and stops.
    """
    rows = read_landing(spark, src, minutes, max_bytes)
    if as_text:
        rows = rows.select("value", "arrived_date")
    writer = (
        rows.writeStream.format("text" if as_text else "parquet")
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", max_records)
        .option("path", dst)
        .partitionBy("arrived_date")
        .outputMode("append")
    )
    trigger = {"availableNow": True} if once else {"processingTime": roll}
    return writer.trigger(**trigger).start()
