"""Generic report shapes: top lists, distributions, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketloom.functions.columns import ratio


def top_n(df: DataFrame, measure: str, ties: Sequence[str], n: int = 10) -> DataFrame:
    """Best rows by a measure. Sort and limit become one top-k, which keeps n rows per task."""
    return df.orderBy(F.col(measure).desc(), *ties).limit(n)


def top_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int = 5, rank: str = "Rank"
) -> DataFrame:
    """Best k rows per key with their rank.

    Each task cuts its rows to k per key before the shuffle, so a hot key ships k rows per task.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, place).where(F.col(rank) <= k)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Value counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def distribution_pct(df: DataFrame, column: str) -> DataFrame:
    """Value counts and their percent of all rows."""
    counts = distribution(df, column)
    total = counts.agg(F.sum("count").alias("total")).scalar()
    return counts.withColumn("pct", ratio("count", total) * 100)


def score_histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram between the smallest and the largest value, which falls in the last bin."""
    value = F.col(column).cast("double")
    span = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("span")).scalar()
    place = F.try_divide(value - span["lo"], span["hi"] - span["lo"]) * bins
    inside = F.least(F.floor(F.coalesce(place, F.lit(0.0))).cast("int"), F.lit(bins - 1))
    return (
        df.where(value.isNotNull())
        .groupBy((inside + 1).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
