"""One row per product id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

# ---- fixed values: ranking columns, and what a missing value counts as ----
_PREFERENCE = (("reviews_count", -1), ("quantity_sold", -1), ("availability", 0), ("price", -1))


def ranking_columns(df: DataFrame, key: str = "id") -> list[str]:
    """The columns that decide which row of an id stays, as far as its quantity is concerned."""
    wanted = (key, *(c for c, _ in _PREFERENCE), "category", "source_file")
    return [c for c in wanted if c in df.columns]


def best_row_per_id(df: DataFrame, key: str = "id") -> DataFrame:
    """Keep the row with most reviews, then most sold, then available, then dearest.

    Rows without an id count as one product.  Ties follow the order of the
    files (category, then file name), then a known quantity comes before an
    unknown one, then a hash of the row, so the result does not depend on
    partitioning, and the chosen quantity not on the other columns.  `row_number = 1` is cut down inside each
    map task before the shuffle, so a hot id costs one row per task.
    """
    ranking = [
        F.coalesce(F.col(c), F.lit(missing)).desc() for c, missing in _PREFERENCE if c in df.columns
    ]
    files = [F.col(c).asc_nulls_last() for c in ("category", "source_file") if c in df.columns]
    sold = [F.col("quantity_sold").desc_nulls_last()] if "quantity_sold" in df.columns else []
    per_id = Window.partitionBy(key).orderBy(*ranking, *files, *sold, F.xxhash64(*df.columns))
    return df.withColumn("_place", F.row_number().over(per_id)).where("_place = 1").drop("_place")
