"""Association of product columns with price."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflens.operators.association import correlation_ratio, spearman
from shelflens.plans import price_model, screening

from .model_queries import PART
from .registry import products, query

# What is left of the products view once excluded columns are dropped.  Flags:
# the badge flag has no gaps and is a number, the brand flag has and is not.
_NUMERIC = ("quantity_sold", "log_quantity_sold", "reviews_count", "rating_average", "star_5_percent",
            "star_1_percent", "badges_new_has_authentic_badge")
_CATEGORICAL = ("name", "category", "brand_name", "brand_or_author", "current_seller", "categories",
                "primary_category_path", "is_top_brand")


def _rho(a, b):
    """Rank correlation of two columns over the rows where both are known."""
    def rank(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / CAST(2 AS DOUBLE)"

    known = f"SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM products WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    corr = f"SELECT corr(rx, ry) FROM (SELECT {rank('x')} AS rx, {rank('y')} AS ry FROM ({known}))"
    return f"round(({corr}), 8)"


def _numeric_row(c):
    return f"""SELECT '{c}' AS feature, 'numeric_or_binary' AS feature_type, 'spearman' AS association_method,
      {_rho(c, 'price')} AS association_value, (SELECT COUNT(DISTINCT {c}) FROM products) AS n_unique"""


def _eta(c):
    return f"""(SELECT round(sqrt(SUM((m - overall) * (m - overall)) / SUM((y - overall) * (y - overall))), 8) FROM (
      SELECT CAST(price AS DOUBLE) AS y, AVG(CAST(price AS DOUBLE)) OVER (PARTITION BY {c}) AS m,
        AVG(CAST(price AS DOUBLE)) OVER () AS overall
      FROM products WHERE {c} IS NOT NULL AND price IS NOT NULL))"""


def _categorical_row(c):
    return f"""SELECT '{c}' AS feature, 'categorical' AS feature_type, 'eta' AS association_method,
      {_eta(c)} AS association_value, (SELECT COUNT(DISTINCT {c}) FROM products) AS n_unique"""


_TABLE = " UNION ALL ".join([_numeric_row(c) for c in _NUMERIC] + [_categorical_row(c) for c in _CATEGORICAL])


def _materialized(sql):
    """The view is used many times over: compute it once."""
    return sql.replace("FROM products", "FROM once")


_ONCE = "once AS MATERIALIZED (SELECT * FROM products)"


@query("spearman_vs_price", f"WITH {_ONCE} " + _materialized(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_rho(c, 'price')} AS rho" for c in _NUMERIC
)))
def spearman_vs_price(spark, sf_dir):
    found = spearman(products(spark, sf_dir), [(c, "price") for c in _NUMERIC])
    return found.select(F.col("a").alias("feature"), F.round("rho", 8).alias("rho"))


@query("eta_vs_price", f"WITH {_ONCE} " + _materialized(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_eta(c)} AS eta, (SELECT COUNT(DISTINCT {c}) FROM products) AS n_unique"
    for c in _CATEGORICAL
)))
def eta_vs_price(spark, sf_dir):
    found = correlation_ratio(products(spark, sf_dir), _CATEGORICAL, "price")
    return found.withColumn("eta", F.round("eta", 8))


def _rounded(associations):
    return associations.withColumns({c: F.round(c, 8) for c in ("association_value", "abs_association")})


@query("association_table", f"WITH {_ONCE} " + _materialized(
    f"SELECT *, abs(association_value) AS abs_association FROM ({_TABLE})"
))
def association_table(spark, sf_dir):
    return _rounded(screening.association_table(products(spark, sf_dir)))


@query("selected_features", f"WITH {_ONCE} " + _materialized(
    f"SELECT feature FROM ({_TABLE}) WHERE abs(association_value) >= 0.05"
))
def selected_features(spark, sf_dir):
    return screening.selected_features(screening.association_table(products(spark, sf_dir)))


_MATRIX_COLUMNS = (*_NUMERIC, "price")


@query("spearman_matrix", f"WITH {_ONCE} " + _materialized(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_rho(a, b)} AS rho"
    for a in _MATRIX_COLUMNS for b in _MATRIX_COLUMNS
)))
def spearman_matrix(spark, sf_dir):
    return screening.rank_matrix(products(spark, sf_dir)).withColumn("rho", F.round("rho", 8))


_TRAINING = _ONCE.replace("SELECT * FROM products", f"SELECT * FROM products WHERE price >= 0 AND {PART} = 'train'")


@query("selected_model_features", f"WITH {_TRAINING} " + _materialized(
    f"SELECT feature FROM ({_TABLE}) WHERE abs(association_value) >= 0.05"
))
def selected_model_features(spark, sf_dir):
    """The features a model is given that chooses its own: screened on the training rows alone."""
    rows = products(spark, sf_dir)
    chosen = price_model.selected_features(rows)
    table = price_model.model_table(rows, features=chosen)
    kept = [c for c in table.columns if c in chosen]
    return spark.range(1).select(F.explode(F.lit(kept)).alias("feature"))
