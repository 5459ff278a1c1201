"""The four catalogue questions, each in a `sql` and a `frame` dialect.

The dialects differ where the two usual ways of asking differ: a null group is
kept or dropped, ties share a cumulative value or not, halves are rounded away
from zero or to even, and the top 10 % includes ties or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import running_total, top_share_threshold, value_counts
from ..staging import stage

# ---- fixed values: labels, lower bounds and the smallest group reported ----
RATING_LABELS = {
    "sql": ("Excellent (>= 4.5)", "Good (4 - 4.49)", "Average (3 - 3.99)", "Low (< 3)"),
    "frame": ("Excellent (>=4.5)", "Good (4-4.49)", "Average (3-3.99)", "Low (<3)"),
}
RATING_BOUNDS = (4.5, 4.0, 3.0)
BEST, OTHER = "Best Seller", "Non Best Seller"
MIN_PRODUCTS = 30


def _check(dialect: str) -> None:
    if dialect not in RATING_LABELS:
        raise ValueError(f"dialect must be one of {sorted(RATING_LABELS)}, not {dialect!r}")


def _rounded(value: Column, places: int, dialect: str) -> Column:
    return F.round(value, places) if dialect == "sql" else F.bround(value, places)


def _mean_price(dialect: str) -> Column:
    if dialect == "sql":
        return F.avg(F.col("price").cast("decimal(18,2)")).cast("decimal(18,2)").cast("double")
    return F.bround(F.avg("price"), 2)


def gmv_by_category(products: DataFrame, by: str = "category") -> DataFrame:
    """Price times quantity sold, summed by category, over rows that have both."""
    sold = products.where(F.col("price").isNotNull() & F.col("quantity_sold").isNotNull())
    return sold.groupBy(by).agg(
        F.sum(F.col("price").cast("bigint") * F.col("quantity_sold")).alias("gmv_proxy")
    )


def _frame_gmv(products: DataFrame, by: str) -> DataFrame:
    """Per-category GMV with its running total, largest first, ties by name."""
    gmv = gmv_by_category(products.where(F.col(by).isNotNull()), by)
    gmv = gmv.withColumn("gmv_proxy", F.col("gmv_proxy").cast("bigint"))
    return running_total(gmv, [F.col("gmv_proxy").desc(), F.col(by)], "gmv_proxy")


def gmv_share(products: DataFrame, dialect: str = "sql", by: str = "category") -> DataFrame:
    """GMV by category with its share and cumulative share of the whole."""
    _check(dialect)
    if dialect == "frame":
        ran = _frame_gmv(products, by)
        share = F.col("gmv_proxy") / F.col("total") * 100
        cumulative = F.col("running") / F.col("total") * 100
    else:
        # Ties share one cumulative value: run over the distinct amounts.
        gmv = stage(gmv_by_category(products, by), "gmv")
        amounts = gmv.groupBy("gmv_proxy").agg(F.sum("gmv_proxy").alias("amount"))
        ran = gmv.join(running_total(amounts, [F.col("gmv_proxy").desc()], "amount"), "gmv_proxy")
        share = F.col("gmv_proxy") * F.lit(100.0).cast("double") / F.col("total")
        cumulative = F.col("running") * F.lit(100.0).cast("double") / F.col("total")
    return ran.select(
        by,
        "gmv_proxy",
        _rounded(share, 2, dialect).alias("gmv_pct"),
        _rounded(cumulative, 2, dialect).alias("cumulative_gmv_pct"),
    ).orderBy(F.col("gmv_proxy").desc(), F.col(by).asc_nulls_last())


def gmv_cumulative(products: DataFrame, by: str = "category") -> DataFrame:
    """GMV by category with the unrounded cumulative share (for the Pareto chart)."""
    return _frame_gmv(products, by).select(
        by, "gmv_proxy", (F.col("running") / F.col("total") * 100).alias("cum_pct")
    )


def discount_by_category(
    products: DataFrame, dialect: str = "sql", by: str = "category", at_least: int = MIN_PRODUCTS
) -> DataFrame:
    """Product count and mean discount of the categories with enough products."""
    _check(dialect)
    rows = products if dialect == "sql" else products.where(F.col(by).isNotNull())
    return (
        rows.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _rounded(F.avg("discount_rate"), 4, dialect).alias("avg_discount_rate"),
        )
        .where(F.col("product_count") >= at_least)
        .orderBy(F.col("avg_discount_rate").desc_nulls_last(), F.col(by).asc_nulls_last())
    )


def with_top_sellers(products: DataFrame) -> DataFrame:
    """`seller_group`: as many as the smallest quantity in the top 10 % or more.

    The 10 % count all rows and are rounded up; ties at the cut are all in; a
    product of unknown quantity is never a best seller.
    """
    k = F.expr("(total + 9) div 10")
    cut = top_share_threshold(products.select("quantity_sold"), "quantity_sold", k).select("smallest")
    label = F.when(F.col("quantity_sold") >= cut.scalar(), F.lit(BEST)).otherwise(F.lit(OTHER))
    return products.withColumn("seller_group", label)


def with_exact_top_sellers(products: DataFrame, key: str = "id") -> DataFrame:
    """`seller_group`: exactly the first 10 % of rows (rounded up), ties at the cut by `key`.

    Only the rows tied at the cut are ordered by key, and those by running
    counts rather than in one task.  `key` must be unique, as it is once the
    products are deduplicated.
    """
    sold = F.col("quantity_sold")
    k = F.ceil(F.col("total") * F.lit(0.1).cast("double"))
    cut = stage(top_share_threshold(products.select("quantity_sold"), "quantity_sold", k), "cut")
    kth = cut.select("kth").scalar()
    tied = products.where(sold.eqNullSafe(kth)).select(key)
    places = running_total(value_counts(tied, [key]), [F.col(key).asc_nulls_last()], "n")
    wanted = cut.select(F.col("k") - F.col("above")).scalar()
    last = places.where(F.col("running") <= wanted).agg(
        F.max(key).alias("last"), F.coalesce(F.max("running") == F.max("total"), F.lit(False)).alias("every")
    )
    last = stage(last, "cut_key")
    above = F.coalesce(sold > kth, sold.isNotNull() & F.isnull(kth))
    among = sold.eqNullSafe(kth) & F.coalesce(
        last.select("every").scalar() | (F.col(key) <= last.select("last").scalar()), F.lit(False)
    )
    return products.withColumn("seller_group", F.when(above | among, F.lit(BEST)).otherwise(F.lit(OTHER)))


def best_seller_comparison(products: DataFrame, dialect: str = "sql") -> DataFrame:
    """Best sellers against the rest: count and mean price, discount, rating, reviews."""
    _check(dialect)
    grouped = with_top_sellers(products) if dialect == "sql" else with_exact_top_sellers(products)
    return (
        grouped.groupBy("seller_group")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _mean_price(dialect).alias("avg_price"),
            _rounded(F.avg("discount_rate"), 4, dialect).alias("avg_discount"),
            _rounded(F.avg("rating_average"), 2, dialect).alias("avg_rating"),
            _rounded(F.avg("reviews_count"), 2, dialect).alias("avg_reviews"),
        )
        .orderBy("seller_group")
    )


def rating_bin(rating: Column, dialect: str = "sql") -> Column:
    """Label of the rating; unknown ratings fall in the lowest bin."""
    *labels, lowest = RATING_LABELS[dialect]
    (first, bound), *others = zip(labels, RATING_BOUNDS)
    label = F.when(rating >= bound, F.lit(first))
    for name, bound in others:
        label = label.when(rating >= bound, F.lit(name))
    return label.otherwise(F.lit(lowest))


def rating_bins(products: DataFrame, dialect: str = "sql") -> DataFrame:
    """Products, mean quantity, mean reviews and mean price by rating bin."""
    _check(dialect)
    return (
        products.groupBy(rating_bin(F.col("rating_average"), dialect).alias("rating_bin"))
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            _rounded(F.avg("quantity_sold"), 0, dialect).alias("avg_quantity_sold"),
            _rounded(F.avg("reviews_count"), 0, dialect).alias("avg_reviews"),
            _mean_price(dialect).alias("avg_price"),
        )
        .orderBy(F.col("avg_quantity_sold").desc_nulls_last(), "rating_bin")
    )
