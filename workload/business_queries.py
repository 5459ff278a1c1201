"""GMV, discounts, best sellers, rating bins and the tables behind their charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflens.plans import business, charts

from .registry import products, query

_GMV = """gmv AS (
  SELECT category, CAST(SUM(price * quantity_sold) AS BIGINT) AS gmv_proxy
  FROM products WHERE price IS NOT NULL AND quantity_sold IS NOT NULL {and_where} GROUP BY category
)"""
_GMV_SQL = _GMV.format(and_where="")
_GMV_FRAME = _GMV.format(and_where="AND category IS NOT NULL")

_CUMULATIVE = f"""WITH {_GMV_FRAME}, cum AS (
  SELECT category, gmv_proxy,
    CAST(SUM(gmv_proxy) OVER (ORDER BY gmv_proxy DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE)
      / CAST(SUM(gmv_proxy) OVER () AS DOUBLE) * 100 AS cum_pct
  FROM gmv)"""


@query("gmv_share_sql", f"""
WITH {_GMV_SQL}
SELECT category, gmv_proxy,
  round(gmv_proxy * CAST(100 AS DOUBLE) / SUM(gmv_proxy) OVER (), 2) AS gmv_pct,
  round(CAST(SUM(gmv_proxy) OVER (ORDER BY gmv_proxy DESC) AS DOUBLE) * 100 / SUM(gmv_proxy) OVER (), 2)
    AS cumulative_gmv_pct
FROM gmv""")
def gmv_share_sql(spark, sf_dir):
    return business.gmv_share(products(spark, sf_dir), "sql")


@query("gmv_share_frame", f"""
WITH {_GMV_FRAME}
SELECT category, gmv_proxy,
  round_even(CAST(gmv_proxy AS DOUBLE) / CAST(SUM(gmv_proxy) OVER () AS DOUBLE) * 100, 2) AS gmv_pct,
  round_even(CAST(SUM(gmv_proxy) OVER (ORDER BY gmv_proxy DESC, category ROWS UNBOUNDED PRECEDING) AS DOUBLE)
    / CAST(SUM(gmv_proxy) OVER () AS DOUBLE) * 100, 2) AS cumulative_gmv_pct
FROM gmv""")
def gmv_share_frame(spark, sf_dir):
    return business.gmv_share(products(spark, sf_dir), "frame")


@query("gmv_share_by_brand", """
WITH gmv AS (SELECT brand_name, CAST(SUM(price * quantity_sold) AS BIGINT) AS gmv_proxy FROM products
  WHERE price IS NOT NULL AND quantity_sold IS NOT NULL GROUP BY brand_name)
SELECT brand_name, gmv_proxy,
  round(gmv_proxy * CAST(100 AS DOUBLE) / SUM(gmv_proxy) OVER (), 2) AS gmv_pct,
  round(CAST(SUM(gmv_proxy) OVER (ORDER BY gmv_proxy DESC) AS DOUBLE) * 100 / SUM(gmv_proxy) OVER (), 2)
    AS cumulative_gmv_pct
FROM gmv""")
def gmv_share_by_brand(spark, sf_dir):
    return business.gmv_share(products(spark, sf_dir), "sql", by="brand_name")


_DISCOUNT = """
SELECT category, COUNT(*) AS product_count, {round}(AVG(discount_rate), 4) AS avg_discount_rate
FROM products {where} GROUP BY category HAVING COUNT(*) >= 30"""


@query("discount_by_category_sql", _DISCOUNT.format(round="round", where=""))
def discount_by_category_sql(spark, sf_dir):
    return business.discount_by_category(products(spark, sf_dir), "sql")


@query("discount_by_category_frame", _DISCOUNT.format(round="round_even", where="WHERE category IS NOT NULL"))
def discount_by_category_frame(spark, sf_dir):
    return business.discount_by_category(products(spark, sf_dir), "frame")


_COMPARE = """
SELECT seller_group, COUNT(*) AS product_count,
  {round}(AVG(CAST(price AS DOUBLE)), 2) AS avg_price, {round}(AVG(discount_rate), 4) AS avg_discount,
  {round}(AVG(rating_average), 2) AS avg_rating, {round}(AVG(reviews_count), 2) AS avg_reviews
FROM grouped GROUP BY seller_group"""

_GROUPED_SQL = """grouped AS (SELECT *, CASE WHEN quantity_sold >= (
    SELECT MIN(quantity_sold) FROM (SELECT quantity_sold FROM products
      ORDER BY quantity_sold DESC NULLS LAST LIMIT (SELECT CAST((COUNT(*) + 9) // 10 AS BIGINT) FROM products)))
  THEN 'Best Seller' ELSE 'Non Best Seller' END AS seller_group FROM products)"""

_GROUPED_FRAME = """grouped AS (SELECT *, CASE WHEN
    ROW_NUMBER() OVER (ORDER BY quantity_sold DESC NULLS LAST, id)
      <= ceil(CAST(0.1 AS DOUBLE) * COUNT(*) OVER ())
  THEN 'Best Seller' ELSE 'Non Best Seller' END AS seller_group FROM products)"""


@query("best_seller_sql", f"WITH {_GROUPED_SQL} {_COMPARE.format(round='round')}")
def best_seller_sql(spark, sf_dir):
    return business.best_seller_comparison(products(spark, sf_dir), "sql")


@query("best_seller_frame", f"WITH {_GROUPED_FRAME} {_COMPARE.format(round='round_even')}")
def best_seller_frame(spark, sf_dir):
    return business.best_seller_comparison(products(spark, sf_dir), "frame")


@query("top_sellers_with_ties", f"WITH {_GROUPED_SQL} SELECT id, seller_group FROM grouped")
def top_sellers_with_ties(spark, sf_dir):
    return business.with_top_sellers(products(spark, sf_dir)).select("id", "seller_group")


@query("top_sellers_exact", f"WITH {_GROUPED_FRAME} SELECT id, seller_group FROM grouped")
def top_sellers_exact(spark, sf_dir):
    return business.with_exact_top_sellers(products(spark, sf_dir)).select("id", "seller_group")


def _bins(labels, rounding):
    cases = " ".join(
        f"WHEN rating_average >= {bound} THEN '{label}'" for label, bound in zip(labels, business.RATING_BOUNDS)
    )
    return f"""bins AS (
  SELECT CASE {cases} ELSE '{labels[-1]}' END AS rating_bin, COUNT(*) AS product_count,
    {rounding}(AVG(quantity_sold), 0) AS avg_quantity_sold, {rounding}(AVG(reviews_count), 0) AS avg_reviews,
    {rounding}(AVG(CAST(price AS DOUBLE)), 2) AS avg_price
  FROM products GROUP BY 1)"""


_BINS_SQL = _bins(business.RATING_LABELS["sql"], "round")
_BINS_FRAME = _bins(business.RATING_LABELS["frame"], "round_even")


@query("rating_bins_sql", f"WITH {_BINS_SQL} SELECT * FROM bins")
def rating_bins_sql(spark, sf_dir):
    return business.rating_bins(products(spark, sf_dir), "sql")


@query("rating_bins_frame", f"WITH {_BINS_FRAME} SELECT * FROM bins")
def rating_bins_frame(spark, sf_dir):
    return business.rating_bins(products(spark, sf_dir), "frame")


@query("pareto_top10", f"""{_CUMULATIVE}
SELECT category, gmv_proxy, round(cum_pct, 9) AS cum_pct,
  format('{{:,}}B', CAST(round_even(gmv_proxy / 1e9, 0) AS BIGINT)) AS label,
  CAST(CAST(round_even(cum_pct, 0) AS BIGINT) AS VARCHAR) || '%' AS cum_label
FROM cum ORDER BY gmv_proxy DESC, category LIMIT 10""")
def pareto_top10(spark, sf_dir):
    return charts.pareto(products(spark, sf_dir)).withColumn("cum_pct", F.round("cum_pct", 9))


@query("categories_to_80", f"""{_CUMULATIVE}
SELECT COUNT(*) FILTER (WHERE cum_pct <= 80) + 1 AS categories FROM cum""")
def categories_to_80(spark, sf_dir):
    return charts.categories_to_share(products(spark, sf_dir))


@query("discount_shade", f"""
WITH bars AS ({_DISCOUNT.format(round="round_even", where="WHERE category IS NOT NULL")})
SELECT category, avg_discount_rate, round(avg_discount_rate / MAX(avg_discount_rate) OVER (), 9) AS shade,
  printf('%.2f%%', avg_discount_rate) AS label
FROM bars""")
def discount_shade(spark, sf_dir):
    return charts.discount_bars(products(spark, sf_dir)).withColumn("shade", F.round("shade", 9))


@query("best_seller_panels", f"""
WITH {_GROUPED_FRAME}, compared AS ({_COMPARE.format(round='round_even')})
SELECT seller_group, metric, value, printf('%.2f', value) AS label FROM (
  SELECT seller_group, 'avg_price' AS metric, avg_price AS value FROM compared
  UNION ALL SELECT seller_group, 'avg_discount', avg_discount FROM compared
  UNION ALL SELECT seller_group, 'avg_rating', avg_rating FROM compared
  UNION ALL SELECT seller_group, 'avg_reviews', avg_reviews FROM compared)""")
def best_seller_panels(spark, sf_dir):
    return charts.best_seller_panels(products(spark, sf_dir))


_BARS = ", ".join(f"({i}, '{label}')" for i, label in enumerate(charts.RATING_ORDER))


@query("rating_ordered", f"""
WITH {_BINS_FRAME}, shelf AS (SELECT * FROM (VALUES {_BARS}) v(bar, rating_bin))
SELECT bar, shelf.rating_bin, coalesce(avg_quantity_sold, 0) AS avg_quantity_sold
FROM shelf LEFT JOIN bins ON shelf.rating_bin = bins.rating_bin""")
def rating_ordered(spark, sf_dir):
    return charts.rating_bars(products(spark, sf_dir))
