"""Which columns go with price: association table, selected features, rank matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..operators.association import correlation_ratio, rank_correlations, spearman
from ..schema import SCREENING_EXCLUDED

TARGET = "price"
MIN_ASSOCIATION = 0.05  # fixed value: weakest association that selects a feature


def screening_table(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Columns that may be screened, flags without gaps turned to 0 and 1.

    A flag with unknown values is a category (true, false), one without is a
    number.  Telling them apart takes one row of counts over the flags.
    """
    df = df.drop(*SCREENING_EXCLUDED)
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, BooleanType)]
    if not flags:
        return df
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in flags]).first()
    return df.withColumns({c: F.col(c).cast("int") for c in flags if gaps[c] == 0})


def split_columns(df: DataFrame, target: str = TARGET) -> tuple[list[str], list[str]]:
    """Names of numeric columns and of all others, the target left out."""
    features = [f for f in df.schema.fields if f.name != target]
    numeric = [f.name for f in features if isinstance(f.dataType, NumericType)]
    return numeric, [f.name for f in features if f.name not in numeric]


def numeric_associations(table: DataFrame, numeric: list[str], target: str = TARGET) -> DataFrame:
    """Rank correlation of each numeric column with the target."""
    found = spearman(table, [(c, target) for c in numeric])
    return found.select(
        F.col("a").alias("feature"),
        F.lit("numeric_or_binary").alias("feature_type"),
        F.lit("spearman").alias("association_method"),
        F.col("rho").alias("association_value"),
        F.abs("rho").alias("abs_association"),
        F.col("distinct_a").alias("n_unique"),
    )


def categorical_associations(table: DataFrame, categorical: list[str], target: str = TARGET) -> DataFrame:
    """Correlation ratio of each categorical column with the target."""
    found = correlation_ratio(table, categorical, target)
    return found.select(
        "feature",
        F.lit("categorical").alias("feature_type"),
        F.lit("eta").alias("association_method"),
        F.col("eta").alias("association_value"),
        F.col("eta").alias("abs_association"),
        "n_unique",
    )


def association_table(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Association of every column with the target, strongest first."""
    table = screening_table(df, target)
    numeric, categorical = split_columns(table, target)
    parts = []
    if numeric:
        parts.append(numeric_associations(table, numeric, target))
    if categorical:
        parts.append(categorical_associations(table, categorical, target))
    if not parts:
        raise ValueError(f"no column to compare with {target}")
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return whole.orderBy(F.col("abs_association").desc_nulls_last(), "feature")


def selected_features(associations: DataFrame, at_least: float = MIN_ASSOCIATION) -> DataFrame:
    """Features whose association reaches the threshold."""
    return associations.where(F.col("abs_association") >= at_least).select("feature")


def rank_matrix(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Spearman correlation of all numeric columns with each other, as cells.

    Each pair is computed once and mirrored; a column goes with itself
    perfectly unless it is constant.
    """
    table = screening_table(df, target)
    numeric, _ = split_columns(table, target)
    columns = [*numeric, target]
    cells = rank_correlations(table, columns).select(
        F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), "rho"
    )
    both = F.array(F.struct("feature_a", "feature_b"), F.struct(
        F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b")
    ))
    sides = F.when(F.col("feature_a") == F.col("feature_b"), F.slice(both, 1, 1)).otherwise(both)
    return cells.select(F.inline(sides), "rho")
