"""Catalogue tables derived from `part` and `lineitem`, as SQL both engines read.

Nulls and dirty values are put in by key, as the tables have none.  `{part}`
and the like stand for a table: a parquet path in Spark, a view in the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_SALES = """
SELECT l_partkey,
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
  CAST(COUNT(*) AS BIGINT) AS n,
  CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS kept,
  CAST(SUM(CAST(round(l_discount * 100, 0) AS BIGINT)) AS BIGINT) AS disc,
  CAST(SUM(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) AS BIGINT) AS s1,
  CAST(SUM(CASE WHEN l_linenumber = 2 THEN 1 ELSE 0 END) AS BIGINT) AS s2,
  CAST(SUM(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS BIGINT) AS s3,
  CAST(SUM(CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END) AS BIGINT) AS s4,
  CAST(SUM(CASE WHEN l_linenumber >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS s5
FROM {lineitem} GROUP BY l_partkey
"""

# One row per part with its sales; everything below is built from it.
BASE = f"""
SELECT p_partkey AS id, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
  CAST(round(p_retailprice * 100, 0) AS BIGINT) AS cents,
  coalesce(qty, 0) AS qty, coalesce(n, 0) AS n, coalesce(kept, 0) AS kept, coalesce(disc, 0) AS disc,
  coalesce(s1, 0) AS s1, coalesce(s2, 0) AS s2, coalesce(s3, 0) AS s3, coalesce(s4, 0) AS s4, coalesce(s5, 0) AS s5
FROM {{part}} LEFT JOIN ({_SALES}) sales ON p_partkey = l_partkey
"""

_NAME = """p_name || CASE WHEN p_size % 4 = 0 THEN ' RAM 8GB 128 GB' WHEN p_size % 4 = 1 THEN ' 1,5TB'
    WHEN p_size % 4 = 2 THEN ' 6.5 inch' ELSE ' combo' END"""

# A clean product table.
PRODUCTS = f"""
SELECT id,
  {_NAME} AS name,
  CASE WHEN id % 53 = 0 THEN NULL ELSE p_name END AS category,
  p_brand AS brand_name,
  'id:' || CAST(p_size AS STRING) || '; name:' || p_brand AS brand_or_author,
  'id:' || CAST(id % 7 AS STRING) || '; name:' || p_type AS current_seller,
  'id:' || CAST(p_size % 9 AS STRING) || '; name:' || p_name || '; is_leaf:True' AS categories,
  '1/2/' || p_type AS primary_category_path,
  CASE WHEN id % 59 = 0 THEN NULL ELSE cents END AS price,
  CASE WHEN id % 11 = 0 THEN NULL ELSE qty END AS quantity_sold,
  CASE WHEN id % 11 = 0 THEN NULL ELSE ln(1 + CAST(qty AS DOUBLE)) END AS log_quantity_sold,
  n AS reviews_count,
  CASE WHEN n = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(5 * kept AS DOUBLE) / CAST(n AS DOUBLE) END AS rating_average,
  CASE WHEN id % 13 = 0 OR n = 0 THEN NULL ELSE CAST(disc AS DOUBLE) / CAST(n AS DOUBLE) END AS discount_rate,
  CASE WHEN n = 0 THEN NULL ELSE CAST(100 * s5 AS DOUBLE) / CAST(n AS DOUBLE) END AS star_5_percent,
  CASE WHEN n = 0 THEN NULL ELSE CAST(100 * s1 AS DOUBLE) / CAST(n AS DOUBLE) END AS star_1_percent,
  p_size % 5 = 0 AS badges_new_has_authentic_badge,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size % 2 = 0 END AS is_top_brand
FROM ({BASE}) base
"""

_RATING = """CASE WHEN id % 43 = 0 THEN '7.5' WHEN n = 0 THEN '0.0'
    ELSE CAST(round(CAST(50 * kept AS DOUBLE) / CAST(n AS DOUBLE), 0) / 10 AS STRING) END"""
_DISCOUNT = """CASE WHEN id % 47 = 0 THEN '-1' WHEN id % 47 = 1 THEN '140' WHEN n = 0 THEN ' None '
    ELSE CAST(round(CAST(disc AS DOUBLE) / CAST(n AS DOUBLE), 0) AS STRING) END"""


def _star(level: int) -> str:
    part = f"CAST(floor(100 * CAST(s{level} AS DOUBLE) / CAST(n AS DOUBLE)) AS BIGINT)"
    if level == 2:
        shown = f"CASE WHEN id % 31 = 0 THEN 'None' ELSE CAST({part} AS STRING) END"
    else:
        shown = f"CAST({part} AS STRING)"
    return f"'{level}:count_' || CAST(s{level} AS STRING) || ',percent_' || {shown}"


_STARS = "CASE WHEN n = 0 THEN '' ELSE " + " || ';' || ".join(_star(level) for level in range(1, 6)) + " END"

_BADGES_NEW = """CASE WHEN id % 7 = 0 THEN NULL
    WHEN id % 7 = 1 THEN '[{{''code'': ''authentic_brand'', ''icon'': None, ''ok'': True}}]'
    WHEN id % 7 = 2 THEN '[{{''code'': ''video_icon_2'', ''type'': ''delivery_info_badge''}}]'
    WHEN id % 7 = 3 THEN '[{{"code": "video_icon", "type": "variant_count"}}]'
    ELSE '[]' END"""

# The raw columns, all text, once per source file.
_RAW_COLUMNS = f"""
  CAST(id AS STRING) AS id,
  '0' || CAST(id * 7 AS STRING) AS sku,
  '  ' || {_NAME} || ' ' AS name,
  CAST(id + 1 AS STRING) AS seller_product_id,
  CAST(id % 7 AS STRING) AS seller_id,
  CASE WHEN id % 27 = 0 THEN '' ELSE 'is_authentic:' || CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END
    || '; is_freeship_xtra:' || CASE WHEN p_size % 4 < 2 THEN 'true' ELSE 'FALSE' END
    || '; is_hero:True; is_top_brand:'
    || CASE WHEN p_size % 3 = 0 THEN 'None' WHEN p_size % 3 = 1 THEN 'True' ELSE 'False' END
    || '; return_reason:a:b'
    || CASE WHEN id % 23 = 0 THEN '; is_hero:False' ELSE '' END END AS tracking_info_amplitude,
  CASE WHEN id % 6 = 0 THEN ' N/A ' ELSE ' available' END AS inventory_status,
  CASE WHEN p_size % 2 = 0 THEN 'instock' ELSE 'backorder ' END AS inventory_type,
  '3300' AS data_version,
  CAST(id % 400 AS STRING) || '.0' AS day_ago_created,
  CASE WHEN id % 17 = 0 THEN 'id:1,2; name:Alpha, Beta' WHEN id % 19 = 0 THEN 'id:None; name:None'
    WHEN id % 29 = 0 THEN '-' ELSE 'id:' || CAST(p_size AS STRING) || '; name:' || p_brand END AS brand_or_author,
  'id:' || CAST(id % 7 AS STRING) || '; sku:' || CAST(id AS STRING) || '; name:' || p_type AS current_seller,
  'max_sale_qty:1000; min_sale_qty:1; qty:' || CASE WHEN id % 10 = 0 THEN '1,000' WHEN id % 29 = 0 THEN 'None'
    ELSE CAST(p_size AS STRING) END AS stock_item,
  'id:' || CAST(p_size % 9 AS STRING) || '; name:' || p_name || '; is_leaf:True' AS categories,
  CAST(id % 4 AS STRING) AS benefits_count,
  {_RATING} AS rating_average,
  {_STARS} AS stars,
  '57' AS productset_id,
  '1/2/' || p_type AS primary_category_path,
  CASE WHEN id % 37 = 0 THEN 'N/A' WHEN id % 41 = 0 THEN ' - ' WHEN id % 61 = 0 THEN 'abc'
    WHEN id % 67 = 0 THEN '1,000' WHEN id % 71 = 0 THEN '1e5' ELSE CAST(cents AS STRING) END AS price,
  CAST(cents + 1000 AS STRING) AS original_price,
  '1000' AS discount,
  {_DISCOUNT} AS discount_rate,
  '0' AS favourite_count,
  {_BADGES_NEW} AS badges_new,
  CASE WHEN id % 2 = 0 THEN '[]' ELSE 'NULL' END AS badges_v3,
  '0' AS product_reco_score,
  '1' AS availability,
  CASE WHEN id % 3 = 0 THEN 'False' ELSE 'True' END AS shippable,
  p_name AS category"""

# ` name ` is padded, the second file repeats every fifth product with other
# counts, and every fiftieth with the same ones.
PRODUCTS_RAW = f"""
SELECT {_RAW_COLUMNS},
  CAST(n AS STRING) AS reviews_count,
  CASE WHEN id % 11 = 0 THEN 'nan' ELSE CAST(qty AS STRING) || '.0' END AS quantity_sold,
  'page01.csv' AS source_file
FROM ({BASE}) base
UNION ALL
SELECT {_RAW_COLUMNS},
  CASE WHEN id % 50 = 0 THEN CAST(n AS STRING) WHEN id % 3 = 0 THEN '..' ELSE CAST(n + id % 3 AS STRING) END
    AS reviews_count,
  CASE WHEN id % 50 = 0 AND id % 11 <> 0 THEN CAST(qty AS STRING) || '.0' ELSE CAST(qty + id % 4 - 2 AS STRING) END
    AS quantity_sold,
  'page02.csv' AS source_file
FROM ({BASE}) base WHERE id % 5 = 0
"""

# Landed payloads as JSON text, keyed the way they are fetched.
PAYLOADS = f"""
SELECT id AS product_id, id + 1 AS spid, id % 7 AS seller_id,
  '{{{{"id":' || CAST(id AS STRING) || ',"sku":"' || CAST(id * 7 AS STRING) || '","name":"' || p_name
    || '","seller_product_id":' || CAST(id + 1 AS STRING) || ',"seller_id":' || CAST(id % 7 AS STRING)
    || ',"price":' || CAST(cents AS STRING) || ',"badges_new":[{{{{"code":"authentic_brand"}}}}],"quantity_sold":'
    || CASE WHEN id % 11 = 0 THEN 'null' WHEN id % 2 = 0 THEN '{{{{"text":"Sold","value":' || CAST(qty AS STRING) || '}}}}'
       ELSE CAST(qty AS STRING) END
    || ',"availability":1,"shippable":' || CASE WHEN id % 3 = 0 THEN 'false' ELSE 'true' END || '}}}}' AS listing,
  '{{{{"product_id":' || CAST(id AS STRING) || ',"spid":' || CAST(id + 1 AS STRING)
    || CASE WHEN id % 8 = 0 THEN '' ELSE ',"tracking_info":{{{{"amplitude":{{{{"is_authentic":true,"is_freeship_xtra":'
       || CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END
       || ',"is_hero":null,"return_reason":"defective"}}}}}}}}' END
    || ',"inventory_status":"available","data_version":3300,"day_ago_created":' || CAST(id % 400 AS STRING)
    || CASE WHEN id % 6 = 0 THEN ',"authors":[{{{{"id":' || CAST(p_size AS STRING)
       || ',"name":"Ann"}}}},{{{{"id":null,"name":""}}}},{{{{"id":9,"name":"Bo"}}}}]'
       WHEN id % 6 = 3 THEN ',"authors":[{{{{"id":null,"name":null}}}}]'
       WHEN id % 6 = 1 THEN ',"authors":[]' ELSE '' END
    || CASE WHEN id % 5 = 0 THEN '' ELSE ',"brand":{{{{"id":' || CAST(p_size AS STRING) || ',"name":"' || p_brand || '"}}}}' END
    || CASE WHEN id % 10 = 0 THEN ',"current_seller":null' ELSE ',"current_seller":{{{{"id":' || CAST(id % 7 AS STRING)
       || ',"sku":"' || CAST(id AS STRING) || '","name":"' || p_type || '","is_best_store":false}}}}' END
    || ',"stock_item":{{{{"qty":' || CAST(p_size AS STRING) || ',"min_sale_qty":1,"max_sale_qty":1000}}}}'
    || CASE WHEN id % 4 = 0 THEN ',"categories":[{{{{"id":1,"name":"Root","is_leaf":false}}}},{{{{"id":'
       || CAST(p_size AS STRING) || ',"name":"' || p_name || '","is_leaf":true}}}}]'
       WHEN id % 4 = 1 THEN ',"categories":{{{{"id":' || CAST(p_size AS STRING) || ',"name":"' || p_name
       || '","is_leaf":true}}}}' WHEN id % 4 = 2 THEN ',"categories":[]' ELSE '' END
    || CASE WHEN id % 3 = 0 THEN ',"benefits":[{{{{"a":1}}}},{{{{"b":2}}}}]' WHEN id % 3 = 1 THEN ',"benefits":{{{{"x":1}}}}'
       ELSE '' END || '}}}}' AS detail,
  CASE WHEN id % 9 = 0 THEN NULL ELSE '{{{{"product_id":' || CAST(id AS STRING) || ',"spid":' || CAST(id + 1 AS STRING)
    || ',"seller_id":' || CAST(id % 7 AS STRING)
    || CASE WHEN id % 4 = 0 THEN ',"rating_average":0,"reviews_count":null' WHEN id % 4 = 1 THEN
       ',"rating_average":4.5,"reviews_count":' || CAST(n AS STRING) ELSE '' END
    || CASE WHEN id % 2 = 0 THEN ',"rating_summary":{{{{"rating_average":3.5,"reviews_count":' || CAST(n AS STRING)
       || ',"stars":{{{{"1":{{{{"count":' || CAST(s1 AS STRING) || ',"percent":10}}}},"2":{{{{"count":2}}}},"3":{{{{}}}}}}}}}}}}' ELSE '' END
    || CASE WHEN id % 4 = 2 THEN '' ELSE ',"stars":{{{{"1":' || CAST(s1 AS STRING)
       || ',"2":0,"4":{{{{"count":null,"percent":null}}}},"5":{{{{"count":' || CAST(s5 AS STRING)
       || ',"percent":' || CAST(s4 AS STRING) || '}}}}}}}}' END
    || '}}}}' END AS review
FROM ({BASE}) base
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view in Spark: table names become parquet paths."""
    return spark.sql(sql.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))


def in_check(sql: str) -> str:
    """The same view for the check, where the tables have their own names."""
    return sql.format(**{t: t for t in TABLES})
