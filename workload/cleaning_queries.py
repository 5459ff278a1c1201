"""Cleaning steps one by one, then the whole clean table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflens.functions import names, packed, text
from shelflens.operators.dedup import best_row_per_id
from shelflens.plans import clean, load
from shelflens.schema import (
    BADGE_WORDS, NAME_KEYWORDS, NULL_TOKENS, RAW_TYPES, STAR_LEVELS, STOCK_KEYS, TRACKING_FLAGS,
)
from shelflens.sources import sinks
from shelflens.staging import stage, stage_path

from .registry import products_raw, query

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_KEY = "CAST(id AS BIGINT) AS id, source_file"


def _nulled(column):
    return f"CASE WHEN lower(trim({column})) IN ({_TOKENS}) THEN NULL ELSE {column} END"


def _kv(column, key):
    """Last entry of a key, in the check's own way: all matches, last one."""
    return rf"trim(list_last(regexp_extract_all({column}, '(?:^|;)\s*{key}\s*:([^;]*)', 1)))"


def _flag(column, key):
    value = f"lower({_kv(column, key)})"
    return f"CASE WHEN {value} = 'true' THEN true WHEN {value} = 'false' THEN false END"


def _stock(key):
    digits = f"replace({_kv('stock_item', key)}, ',', '')"
    return rf"CASE WHEN regexp_full_match({digits}, '-?[0-9]+([.][0-9]+)?') THEN CAST({digits} AS DOUBLE) END"


def _star(level, part):
    group = 1 if part == "count" else 2
    found = rf"list_last(regexp_extract_all(stars, '(?:^|;)\s*{level}\s*:\s*count_(\d+)\s*,\s*percent_(\d+)', {group}))"
    return f"TRY_CAST({found} AS BIGINT)"


def _badge(column, suffix):
    return rf"regexp_matches(coalesce({column}, ''), '\b{BADGE_WORDS[suffix]}\b')"


_BRAND_ID = r"TRY_CAST(nullif(regexp_extract(brand_or_author, '\bid\s*:\s*([0-9]+)', 1), '') AS BIGINT)"
_BRAND_NAME = r"nullif(trim(regexp_extract(trim(brand_or_author), '\bname\s*:\s*(.+)$', 1)), '')"
_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _keyed(df, *columns):
    return df.select(F.col("id").cast("bigint").alias("id"), "source_file", *columns)


@query("null_tokens", f"""
SELECT {_KEY}, {_nulled('price')} AS price, {_nulled('inventory_status')} AS inventory_status,
  {_nulled('badges_v3')} AS badges_v3, {_nulled('quantity_sold')} AS quantity_sold,
  {_nulled('reviews_count')} AS reviews_count, {_nulled('name')} AS name
FROM products_raw""")
def null_tokens(spark, sf_dir):
    df = clean.null_tokens_to_null(products_raw(spark, sf_dir))
    return _keyed(df, "price", "inventory_status", "badges_v3", "quantity_sold", "reviews_count", "name")


@query("numeric_coercion", f"""
SELECT {_KEY}, CAST(TRY_CAST(price AS DOUBLE) AS BIGINT) AS price,
  CASE WHEN quantity_sold = 'nan' THEN NULL ELSE TRY_CAST(quantity_sold AS DOUBLE) END AS quantity_sold,
  CAST(TRY_CAST(day_ago_created AS DOUBLE) AS BIGINT) AS day_ago_created,
  TRY_CAST(reviews_count AS BIGINT) AS reviews_count, CAST(shippable AS BOOLEAN) AS shippable
FROM products_raw""")
def numeric_coercion(spark, sf_dir):
    columns = ("price", "quantity_sold", "day_ago_created", "reviews_count", "shippable")
    return _keyed(
        products_raw(spark, sf_dir), *[text.to_type(F.col(c), RAW_TYPES[c]).alias(c) for c in columns]
    )


@query("trim_text", f"""
SELECT {_KEY}, trim(name) AS name, trim(inventory_status) AS inventory_status,
  trim(inventory_type) AS inventory_type, trim(category) AS category
FROM products_raw""")
def trim_text(spark, sf_dir):
    columns = ("name", "inventory_status", "inventory_type", "category")
    return _keyed(products_raw(spark, sf_dir), *[text.strip(F.col(c)).alias(c) for c in columns])


@query("range_to_null", f"""
SELECT {_KEY},
  CASE WHEN TRY_CAST(discount_rate AS DOUBLE) BETWEEN 0 AND 100 THEN TRY_CAST(discount_rate AS DOUBLE) END AS discount_rate,
  CASE WHEN TRY_CAST(rating_average AS DOUBLE) BETWEEN 0 AND 5 THEN TRY_CAST(rating_average AS DOUBLE) END AS rating_average
FROM products_raw""")
def range_to_null(spark, sf_dir):
    columns = ("discount_rate", "rating_average")
    typed = _keyed(products_raw(spark, sf_dir), *[text.to_double(F.col(c)).alias(c) for c in columns])
    return clean.drop_out_of_range(typed)


@query("kv_flags", f"""
SELECT {_KEY}, {', '.join(f"{_flag('tracking_info_amplitude', k)} AS {k}" for k in TRACKING_FLAGS)}
FROM products_raw""")
def kv_flags(spark, sf_dir):
    packed_flags = F.col("tracking_info_amplitude")
    return _keyed(products_raw(spark, sf_dir), *[packed.kv_flag(packed_flags, k).alias(k) for k in TRACKING_FLAGS])


@query("kv_entries", r"""
WITH parts AS (
  SELECT id, source_file, trim(unnest(string_split(tracking_info_amplitude, ';'))) AS part,
    generate_subscripts(string_split(tracking_info_amplitude, ';'), 1) AS place
  FROM products_raw
), pairs AS (
  SELECT id, source_file, place, trim(regexp_extract(part, '^([^:]*):', 1)) AS k,
    trim(regexp_replace(part, '^[^:]*:', '')) AS v
  FROM parts WHERE contains(part, ':')
)
SELECT CAST(id AS BIGINT) AS id, source_file, k, arg_max(v, place) AS v FROM pairs GROUP BY id, source_file, k""")
def kv_entries(spark, sf_dir):
    entries = packed.kv_entries(F.col("tracking_info_amplitude"))
    return _keyed(products_raw(spark, sf_dir), F.inline(entries))


@query("stock_numbers", f"""
SELECT {_KEY}, {', '.join(f"{_stock(k)} AS stock_{k}" for k in STOCK_KEYS)}
FROM products_raw""")
def stock_numbers(spark, sf_dir):
    stock = F.col("stock_item")
    return _keyed(products_raw(spark, sf_dir), *[packed.kv_number(stock, k).alias(f"stock_{k}") for k in STOCK_KEYS])


@query("brand_parts", f"""
SELECT {_KEY}, {_BRAND_ID} AS brand_id, {_BRAND_NAME} AS brand_name FROM products_raw""")
def brand_parts(spark, sf_dir):
    brand = F.col("brand_or_author")
    return _keyed(
        products_raw(spark, sf_dir),
        packed.brand_id(brand).alias("brand_id"), packed.brand_name(brand).alias("brand_name"),
    )


_STAR_COLUMNS = [(f"star_{level}_{part}", level, part) for level in STAR_LEVELS for part in ("count", "percent")]


@query("star_columns", f"""
SELECT {_KEY}, {', '.join(f'{_star(level, part)} AS {name}' for name, level, part in _STAR_COLUMNS)}
FROM products_raw""")
def star_columns(spark, sf_dir):
    return _keyed(
        products_raw(spark, sf_dir),
        *[packed.star_part(F.col("stars"), level, part).alias(name) for name, level, part in _STAR_COLUMNS],
    )


_BADGE_COLUMNS = [(f"{c}_{suffix}", c, suffix) for c in ("badges_new", "badges_v3") for suffix in BADGE_WORDS]


@query("badge_flags", f"""
SELECT {_KEY}, {', '.join(f'{_badge(c, suffix)} AS {name}' for name, c, suffix in _BADGE_COLUMNS)}
FROM products_raw""")
def badge_flags(spark, sf_dir):
    return _keyed(
        products_raw(spark, sf_dir),
        *[packed.badge_flag(F.col(c), suffix).alias(name) for name, c, suffix in _BADGE_COLUMNS],
    )


def _lower_name(pattern):
    return rf"TRY_CAST(nullif(regexp_extract(replace(lower(name), ',', '.'), '{pattern}', 1), '') AS DOUBLE)"


_KEYWORD_COLUMNS = ", ".join(
    f"CASE WHEN contains(lower(name), '{w}') THEN 1 ELSE 0 END AS name_has_{w}" for w in NAME_KEYWORDS
)


@query("name_features", rf"""
SELECT {_KEY},
  coalesce({_lower_name(r'(\d+(?:\.\d+)?)\s*tb')} * 1024, {_lower_name(r'(\d+(?:\.\d+)?)\s*gb')}) AS name_storage_gb,
  {_lower_name(r'ram\s*(\d+(?:\.\d+)?)\s*gb')} AS name_ram_gb,
  {_lower_name(r'(\d+(?:\.\d+)?)\s*(?:inch|inches|")')} AS name_inch,
  {_KEYWORD_COLUMNS}
FROM products_raw""")
def name_features(spark, sf_dir):
    features = names.name_features(F.col("name"))
    return _keyed(products_raw(spark, sf_dir), *[c.alias(n) for n, c in features.items()])


def _typed(column):
    value = _nulled(column)
    kind = RAW_TYPES[column]
    if column in ("name", "category", "inventory_status", "inventory_type"):
        return f"trim({value})"
    if kind == "string":
        return value
    if kind == "boolean":
        return f"TRY_CAST({value} AS BOOLEAN)"
    if kind == "double":
        number = f"TRY_CAST({value} AS DOUBLE)"
        bounds = clean.VALID_RANGES.get(column)
        return f"CASE WHEN {number} BETWEEN {bounds[0]} AND {bounds[1]} THEN {number} END" if bounds else number
    return f"CAST(TRY_CAST({value} AS DOUBLE) AS {_SQL_TYPES[kind]})"


_NULLED_ROWS = "nulled AS (SELECT " + ", ".join(f"{_nulled(c)} AS {c}" for c in RAW_TYPES) + " FROM products_raw)"
_DERIVED = ", ".join(
    [f"{_BRAND_ID} AS brand_id", f"{_BRAND_NAME} AS brand_name"]
    + [f"{_flag('tracking_info_amplitude', k)} AS {k}" for k in TRACKING_FLAGS]
    + [f"{_stock(k)} AS stock_{k}" for k in STOCK_KEYS]
    + [f"{_star(level, part)} AS {name}" for name, level, part in _STAR_COLUMNS]
    + [f"{_badge(c, suffix)} AS {name}" for name, c, suffix in _BADGE_COLUMNS]
)
_CLEAN_ROWS = (
    f"{_NULLED_ROWS}, cleaned AS (SELECT " + ", ".join(f"{_typed(c)} AS {c}" for c in RAW_TYPES)
    + f", {_DERIVED} FROM nulled)"
)
_BEST = """best AS (
  SELECT * FROM cleaned QUALIFY ROW_NUMBER() OVER (PARTITION BY id ORDER BY coalesce(reviews_count, -1) DESC,
    coalesce(quantity_sold, -1) DESC, coalesce(availability, 0) DESC, coalesce(price, -1) DESC,
    category, source_file) = 1)"""
_TARGET = "(SELECT quantile_cont(quantity_sold, CAST(0.8 AS DOUBLE)) FROM best)"


@query("clean_rows", f"WITH {_CLEAN_ROWS} SELECT * FROM cleaned")
def clean_rows(spark, sf_dir):
    return clean.clean_rows(products_raw(spark, sf_dir))


@query("best_row_per_id", f"""
WITH {_CLEAN_ROWS}, {_BEST} SELECT id, source_file, reviews_count, quantity_sold, price FROM best""")
def best_rows(spark, sf_dir):
    rows = best_row_per_id(clean.clean_rows(products_raw(spark, sf_dir)))
    return rows.select("id", "source_file", "reviews_count", "quantity_sold", "price")


@query("best_seller_flag", f"""
WITH {_CLEAN_ROWS}, {_BEST}
SELECT id, round(ln(1 + quantity_sold), 9) AS log_quantity_sold, quantity_sold >= {_TARGET} AS best_seller FROM best""")
def best_seller_flag(spark, sf_dir):
    narrow = products_raw(spark, sf_dir).select(
        "id", "reviews_count", "quantity_sold", "availability", "price", "category", "source_file"
    )
    rows = stage(best_row_per_id(clean.clean_rows(narrow)), "best")
    return clean.add_sales_targets(rows).select(
        "id", F.round("log_quantity_sold", 9).alias("log_quantity_sold"), "best_seller"
    )


_CLEAN = f"""
WITH {_CLEAN_ROWS}, {_BEST}
SELECT *, round(ln(1 + quantity_sold), 9) AS log_quantity_sold, quantity_sold >= {_TARGET} AS best_seller FROM best"""


@query("clean_products", _CLEAN)
def clean_products(spark, sf_dir):
    cleaned = clean.clean_products(products_raw(spark, sf_dir))
    return cleaned.withColumn("log_quantity_sold", F.round("log_quantity_sold", 9))


@query("clean_roundtrip", _CLEAN)
def clean_roundtrip(spark, sf_dir):
    """The clean table as CSV, read back with its types."""
    path = stage_path(spark, "clean")
    sinks.write_merged(clean.clean_products(products_raw(spark, sf_dir)), path, "csv")
    back = load.read_csv_table(spark, path)
    return back.withColumn("log_quantity_sold", F.round("log_quantity_sold", 9))
