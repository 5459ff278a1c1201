"""The tables behind the charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import business

# ---- fixed values: bar order of the rating chart, panels of the seller chart ----
RATING_ORDER = tuple(reversed(business.RATING_LABELS["frame"]))
PANELS = ("avg_price", "avg_discount", "avg_rating", "avg_reviews")


def _two_places(value: Column) -> Column:
    """Two decimals, rounded by the exact binary value as chart labels are."""
    return F.call_function("format_number", value, F.lit("0.00"))


def pareto(products: DataFrame, by: str = "category", top: int = 10) -> DataFrame:
    """Largest categories by GMV; the cumulative share counts all categories."""
    return (
        business.gmv_cumulative(products, by)
        .orderBy(F.col("gmv_proxy").desc(), by)
        .limit(top)
        .withColumn("label", F.concat(F.format_number(F.col("gmv_proxy") / 1e9, 0), F.lit("B")))
        .withColumn("cum_label", F.concat(F.bround("cum_pct", 0).cast("bigint").cast("string"), F.lit("%")))
    )


def categories_to_share(products: DataFrame, by: str = "category", share: float = 80.0) -> DataFrame:
    """How many of the largest categories it takes to reach the share of GMV."""
    return business.gmv_cumulative(products, by).agg(
        (F.count_if(F.col("cum_pct") <= share) + 1).alias("categories")
    )


def discount_bars(products: DataFrame, by: str = "category", at_least: int = business.MIN_PRODUCTS) -> DataFrame:
    """Mean discount by category, with the shade of the bar and its label."""
    bars = business.discount_by_category(products, "frame", by, at_least)
    darkest = bars.agg(F.max("avg_discount_rate")).scalar()
    return bars.select(
        by,
        "avg_discount_rate",
        (F.col("avg_discount_rate") / darkest).alias("shade"),
        F.concat(_two_places(F.col("avg_discount_rate")), F.lit("%")).alias("label"),
    )


def best_seller_panels(products: DataFrame) -> DataFrame:
    """Best-seller comparison in long form: one row per metric and group."""
    return (
        business.best_seller_comparison(products, "frame")
        .unpivot("seller_group", list(PANELS), "metric", "value")
        .withColumn("label", _two_places(F.col("value")))
    )


def rating_bars(products: DataFrame) -> DataFrame:
    """Mean quantity by rating bin, lowest first; a bin without products has no bar."""
    order = F.array(*[F.lit(label) for label in RATING_ORDER])
    spark = products.sparkSession
    shelf = spark.range(1).select(F.posexplode(order).alias("bar", "rating_bin"))
    bins = business.rating_bins(products, "frame").select("rating_bin", "avg_quantity_sold")
    return (
        shelf.join(bins, "rating_bin", "left")
        .select("bar", "rating_bin", F.coalesce("avg_quantity_sold", F.lit(0.0)).alias("avg_quantity_sold"))
        .orderBy("bar")
    )
