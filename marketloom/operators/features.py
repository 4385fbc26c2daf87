"""Feature scaling and indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.functions.keys import dense_ids


def standard_scaler(df: DataFrame, columns: Sequence[str], centre: bool = True) -> DataFrame:
    """Columns over their sample standard deviation, shifted by the mean if asked; a constant gives 0."""
    stats = df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in columns],
        *[F.stddev_samp(F.col(c).cast("double")).alias(f"std_{c}") for c in columns],
    )
    s = stats.select(F.struct("*")).scalar()
    scaled = {}
    for c in columns:
        value = F.col(c).cast("double") - (s[f"mean_{c}"] if centre else F.lit(0.0))
        scaled[f"{c}_scaled"] = F.coalesce(F.try_divide(value, s[f"std_{c}"]), F.lit(0.0))
    return df.withColumns(scaled)


def string_index(df: DataFrame, column: str, index: str) -> tuple[DataFrame, DataFrame]:
    """The rows with a dense index of a text column, and the two-column dimension to map it back."""
    dimension = dense_ids(df, column, index)
    return df.join(dimension, column), dimension
