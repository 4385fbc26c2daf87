"""Helpers that several operators share: reading, staging, words, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import prepare

#: Rows in one Arrow batch; texts can be long, so batches are kept short.
BATCH_ROWS = "512"

_STAGED: list[str] = []


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators need."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; the warehouse, which executors share too, where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir") + "/_staged"


def staged(df: DataFrame, label: str, files: int | None = None, codec: str = "snappy") -> DataFrame:
    """The rows, written once as Parquet to the shared folder and read from there.

    Cuts the lineage, so a lost executor costs one read, and keeps column pruning and pushed filters. With
    ``files``, the last stage has no more tasks than that: for results known to be small. ``codec`` zstd takes less disk
    for rows that hold texts.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{uuid.uuid4().hex}/{label}"
    (df if files is None else df.coalesce(max(1, files))).write.option("compression", codec).parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def few(spark: SparkSession) -> int:
    """Some tasks for each core: enough for rows that are small beside the texts."""
    return 4 * spark.sparkContext.defaultParallelism


def first_by_hash(df: DataFrame, column: str, rows: int) -> list:
    """At most ``rows`` distinct values of a text column, in the order of their hash.

    Only hashes are ordered; of the values no more than ``rows`` travel, however many tasks there are.
    """
    hashed = df.where(F.col(column).isNotNull()).select(column, F.xxhash64(column).alias("_hash"))
    cut = hashed.select("_hash").distinct().orderBy("_hash").limit(rows).agg(F.max("_hash").alias("cut")).first()["cut"]
    if cut is None:
        return []
    chosen = hashed.where(F.col("_hash") <= cut).groupBy("_hash").agg(F.min(column).alias("value"))
    return [r["value"] for r in chosen.orderBy("_hash").collect()]


def drop_staged(spark: SparkSession) -> None:
    """Delete what ``staged`` wrote; results that are still lazy must have been read before."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(hadoop).delete(path, True)


def utf8(column: str | Column) -> Column:
    """Text as UTF-8 bytes, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit("")).cast("binary")


def words_of(data: bytes) -> list[bytes]:
    """Maximal runs of bytes that are not ASCII white space (space, tab, line feed to carriage return)."""
    return data.split()


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to about this many rows, for steps that work on whole columns."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def run_starts(sorted_values: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    starts = np.ones(len(sorted_values), dtype=bool)
    starts[1:] = sorted_values[1:] != sorted_values[:-1]
    return starts


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))
