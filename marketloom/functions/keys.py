"""Dense integer ids and repeatable row splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.session import stored


def dense_ids(df: DataFrame, column: str, id_column: str, buckets: int = 1024) -> DataFrame:
    """Distinct values of a column with ids 0..n-1 that depend on the values alone.

    Values are numbered inside hash buckets and shifted by the sizes of the buckets before; only the
    bucket sizes pass through one task, and no label list passes through the driver.
    """
    values = (
        df.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)))
    )
    sizes = values.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    shifts = sizes.select(
        "_bucket", (F.sum("_size").over(W.orderBy("_bucket")) - F.col("_size")).alias("_shift")
    )
    inside = F.row_number().over(W.partitionBy("_bucket").orderBy(column)) - 1
    return (
        values.withColumn("_inside", inside)
        .join(shifts, "_bucket")
        .select(column, (F.col("_shift") + F.col("_inside")).cast("int").alias(id_column))
    )


def ordered_ids(values: DataFrame, column: str, id_column: str) -> DataFrame:
    """Different values of a column with ids 0..n-1 in their order, stored. Only sizes of partitions pass through one task."""
    placed = stored(values.orderBy(column).select(column, F.monotonically_increasing_id().alias("_place")))
    # A place is the number of the partition, shifted, and of the row in it.
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    shifts = sizes.select("_part", (F.sum("_size").over(W.orderBy("_part")) - F.col("_size")).alias("_shift"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(shifts, part == F.col("_part")).select(column, (F.col("_shift") + inside).cast("int").alias(id_column))


def hash_position(columns: Sequence[str], seed: int = 42) -> Column:
    """A repeatable number in 0..2^31-1 per row that depends on the key columns alone.

    It comes from the MD5 of seed and keys as text, which other engines compute alike; null keys count as empty.
    """
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary"))
    return F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), 1)


def train_test_split(
    df: DataFrame, keys: Sequence[str], share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split by key; lost tasks recompute the same rows."""
    first = hash_position(keys, seed) < F.lit(int(share * 2**31))
    return df.where(first), df.where(~first)


def spread(left: DataFrame, right: DataFrame, by: str, ways: int) -> tuple[DataFrame, DataFrame]:
    """Salt both sides of a join on a hot key with ``_way``: the left rows are dealt out by a column,
    the right rows are repeated for every way."""
    dealt = left.withColumn("_way", F.pmod(F.xxhash64(by), F.lit(ways)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))
    return dealt, right.withColumn("_way", every)
