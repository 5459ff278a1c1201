"""Fill values for missing features: medians and most frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .ordered import exact_quantile, value_counts


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median per numeric column: `feature`, `median` (no row where all is null)."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    return exact_quantile(long, "value", 0.5, ["feature"], "median")


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values per categorical column with their number of rows."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    return value_counts(long.where(F.col("value").isNotNull()), ["feature", "value"])


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent value per column, the smallest one on ties: `feature`, `mode`."""
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
