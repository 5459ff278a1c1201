"""Payload flattening, CSV folders, unions, sinks and page titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelflens.functions import payload
from shelflens.plans import enrich, ingest, load
from shelflens.schema import DETAIL, LISTING_PAGE, RAW_TYPES, REVIEW
from shelflens.sources import payload_files, sinks
from shelflens.staging import stage_path

from . import views
from .registry import payloads, products, products_raw, query

# ---------------------------------------------------------------- payloads


def _show(value):
    """The check's spelling of a JSON scalar."""
    return f"CASE {value} WHEN 'true' THEN 'True' WHEN 'false' THEN 'False' ELSE coalesce({value}, 'None') END"


def _pack(source, pairs):
    """`k:v; k:v` of JSON paths below `source`."""
    return " || '; ' || ".join(f"'{k}:' || {_show(f'json_extract_string({source}, {path!r})')}" for k, path in pairs)


def _keys(*names, prefix="$."):
    return [(n, prefix + n) for n in names]


def _object(source, path, pairs):
    return f"CASE WHEN json_type({source}, '{path}') = 'OBJECT' THEN {_pack(source, pairs)} ELSE '' END"


_AMPLITUDE = _object(
    "detail", "$.tracking_info.amplitude",
    _keys("is_authentic", "is_freeship_xtra", "is_hero", "is_top_brand", "return_reason",
          prefix="$.tracking_info.amplitude."),
)
_SELLER = _object(
    "detail", "$.current_seller",
    _keys("id", "sku", "name", "store_id", "is_best_store", "is_offline_installment_supported",
          prefix="$.current_seller."),
)
_STOCK = _object("detail", "$.stock_item", _keys("max_sale_qty", "min_sale_qty", "qty", prefix="$.stock_item."))
_BRAND = _object("detail", "$.brand", _keys("id", "name", prefix="$.brand."))
_AUTHOR_IDS = "list_filter(json_extract_string(detail, '$.authors[*].id'), lambda x: x IS NOT NULL)"
_AUTHOR_NAMES = "list_filter(json_extract_string(detail, '$.authors[*].name'), lambda x: x IS NOT NULL AND x <> '')"


def _joined(items, glue):
    return f"coalesce(CASE WHEN len({items}) > 0 THEN array_to_string({items}, '{glue}') END, 'None')"


_AUTHORED = f"'id:' || {_joined(_AUTHOR_IDS, ',')} || '; name:' || {_joined(_AUTHOR_NAMES, ', ')}"
_CATEGORY = f"""CASE json_type(detail, '$.categories')
    WHEN 'OBJECT' THEN {_pack('detail', _keys('id', 'name', 'is_leaf', prefix='$.categories.'))}
    WHEN 'ARRAY' THEN CASE WHEN json_array_length(detail, '$.categories') > 0 THEN
      {_pack('detail', _keys('id', 'name', 'is_leaf', prefix='$.categories[#-1].'))} ELSE '' END
    ELSE '' END"""
_BENEFITS = """CASE json_type(detail, '$.benefits')
    WHEN 'ARRAY' THEN CAST(json_array_length(detail, '$.benefits') AS INTEGER)
    WHEN 'OBJECT' THEN CAST(len(json_keys(detail, '$.benefits')) AS INTEGER) ELSE 0 END"""
_DETAIL_SELECT = f"""SELECT product_id, spid,
  {_AMPLITUDE} AS tracking_info_amplitude,
  json_extract_string(detail, '$.inventory_status') AS inventory_status,
  json_extract_string(detail, '$.inventory_type') AS inventory_type,
  CAST(json_extract_string(detail, '$.data_version') AS BIGINT) AS data_version,
  CAST(json_extract_string(detail, '$.day_ago_created') AS BIGINT) AS day_ago_created,
  CASE WHEN coalesce(json_array_length(detail, '$.authors'), 0) > 0 THEN {_AUTHORED} ELSE {_BRAND} END
    AS brand_or_author,
  {_SELLER} AS current_seller, {_STOCK} AS stock_item, {_CATEGORY} AS categories, {_BENEFITS} AS benefits_count
FROM payloads"""


def _details(spark, sf_dir):
    texts = payloads(spark, sf_dir).select(F.from_json("detail", DETAIL).alias("d"))
    return texts.select("d.*")


@query("flatten_detail", _DETAIL_SELECT)
def flatten_detail(spark, sf_dir):
    return enrich.flatten_detail(_details(spark, sf_dir))


def _number(path, kind):
    return f"CAST(json_extract_string(review, '{path}') AS {kind})"


def _pick(field, kind):
    top, below = _number(f"$.{field}", kind), _number(f"$.rating_summary.{field}", kind)
    consult = """json_type(review, '$.rating_summary') = 'OBJECT'
      AND (coalesce(json_type(review, '$.rating_average'), 'NULL') = 'NULL'
        OR coalesce(json_type(review, '$.reviews_count'), 'NULL') = 'NULL')"""
    return f"CASE WHEN {consult} AND coalesce({top}, 0) = 0 THEN {below} ELSE {top} END"


def _star_entry(level):
    at = f"'$.\"{level}\"'"
    count = f"json_extract_string(stars, '$.\"{level}\".count')"
    percent = f"json_extract_string(stars, '$.\"{level}\".percent')"
    bare = f"json_extract_string(stars, {at})"
    return f"""CASE WHEN json_type(stars, {at}) = 'OBJECT' THEN
        CASE WHEN {count} IS NOT NULL OR {percent} IS NOT NULL
          THEN '{level}:count_' || coalesce({count}, 'None') || ',percent_' || coalesce({percent}, 'None') END
      WHEN json_type(stars, {at}) <> 'NULL' AND {bare} <> '0' THEN '{level}:count_' || {bare} || ',percent_None' END"""


_REVIEW_SELECT = f"""SELECT product_id, spid, seller_id, {_pick('rating_average', 'DOUBLE')} AS rating_average,
  {_pick('reviews_count', 'BIGINT')} AS reviews_count,
  concat_ws(';', {', '.join(_star_entry(level) for level in range(1, 6))}) AS stars
FROM (SELECT *, CASE WHEN json_type(review, '$.stars') = 'OBJECT' THEN json_extract(review, '$.stars')
    ELSE json_extract(review, '$.rating_summary.stars') END AS stars
  FROM payloads WHERE review IS NOT NULL)"""


def _reviews(spark, sf_dir):
    texts = payloads(spark, sf_dir).where("review IS NOT NULL").select(F.from_json("review", REVIEW).alias("r"))
    return texts.select("r.*")


@query("flatten_review", _REVIEW_SELECT)
def flatten_review(spark, sf_dir):
    return enrich.flatten_review(_reviews(spark, sf_dir))


def _listing(path, kind="VARCHAR"):
    return f"CAST(json_extract_string(listing, '$.{path}') AS {kind})"


_LISTING_SELECT = f"""SELECT {_listing('id', 'BIGINT')} AS id, {_listing('sku')} AS sku, {_listing('name')} AS name,
  {_listing('seller_product_id', 'BIGINT')} AS seller_product_id, {_listing('seller_id', 'BIGINT')} AS seller_id,
  {_listing('price', 'BIGINT')} AS price, CAST(json_extract(listing, '$.badges_new') AS VARCHAR) AS badges_new,
  CASE WHEN json_type(listing, '$.quantity_sold') = 'OBJECT' THEN {_listing('quantity_sold.value', 'DOUBLE')}
    ELSE TRY_CAST(json_extract_string(listing, '$.quantity_sold') AS DOUBLE) END AS quantity_sold,
  {_listing('availability', 'INTEGER')} AS availability, {_listing('shippable', 'BOOLEAN')} AS shippable
FROM payloads"""
_LISTED = ("id", "sku", "name", "seller_product_id", "seller_id", "price", "badges_new", "quantity_sold",
           "availability", "shippable")


def _items(spark, sf_dir):
    """Listing pages of forty products, written as they would land, and read back."""
    pages = payloads(spark, sf_dir).select(
        (F.col("product_id").cast("bigint") / 40).cast("bigint").alias("page"),
        F.from_json("listing", LISTING_PAGE["data"].dataType.elementType).alias("item"),
    )
    path = stage_path(spark, "listing")
    pages.groupBy("page").agg(F.collect_list("item").alias("data")).write.json(path)
    return payload_files.read_listing(spark, path, first_page=0)


@query("flatten_listing", _LISTING_SELECT)
def flatten_listing(spark, sf_dir):
    return enrich.flatten_listing(_items(spark, sf_dir)).select(*_LISTED)


_ENRICH = f"""
WITH listed AS ({_LISTING_SELECT}), detailed AS ({_DETAIL_SELECT}), reviewed AS ({_REVIEW_SELECT})
SELECT id, sku, name, seller_product_id, listed.seller_id, tracking_info_amplitude, inventory_status, inventory_type,
  data_version, day_ago_created, brand_or_author, current_seller, stock_item, categories, benefits_count,
  rating_average, reviews_count, coalesce(stars, '') AS stars, price, badges_new, quantity_sold, availability, shippable
FROM listed LEFT JOIN detailed ON id = detailed.product_id AND seller_product_id = detailed.spid
LEFT JOIN reviewed ON id = reviewed.product_id AND seller_product_id = reviewed.spid
  AND listed.seller_id = reviewed.seller_id"""


@query("enrich_products", _ENRICH)
def enrich_products(spark, sf_dir):
    joined = enrich.enrich(_items(spark, sf_dir), _details(spark, sf_dir), _reviews(spark, sf_dir))
    return joined.select(*[c for c in joined.columns if c in _LISTED or c in _JOINED])


_JOINED = ("tracking_info_amplitude", "inventory_status", "inventory_type", "data_version", "day_ago_created",
           "brand_or_author", "current_seller", "stock_item", "categories", "benefits_count", "rating_average",
           "reviews_count", "stars")


# ------------------------------------------------------------------- pages


@query("page_titles", r"""
SELECT page_id, CASE WHEN regexp_matches(html, '(?is)<title(?:\s[^>]*)?>.*?</title\s*>') THEN
    trim(replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>', 1),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'))
  ELSE 'No title' END AS title, substring(html, 1, 5000) AS preview
FROM pages""")
def page_titles(spark, sf_dir):
    pages = payload_files.read_pages(spark, f"{sf_dir}/pages.parquet")
    found = pages.select(
        "page_id", payload.title_element(F.col("html")).alias("element"), payload.page_preview(F.col("html")).alias("preview")
    )
    return found.select("page_id", payload.title_text(F.col("element")).alias("title"), "preview")


@query("odd_page_titles", r"""
SELECT page_id, CASE CAST(page_id AS BIGINT) % 5 WHEN 0 THEN 'new ' || page_id WHEN 1 THEN '© 2024 Aé<b> ' || page_id
  WHEN 2 THEN 'after script' WHEN 3 THEN 'No title' ELSE 'R&D & more; ½' END AS title FROM pages""")
def odd_page_titles(spark, sf_dir):
    """Titles in comments and scripts, and entities in every spelling, before the page's own text."""
    pages = payload_files.read_pages(spark, f"{sf_dir}/pages.parquet")
    head = F.element_at(F.array(
        F.concat(F.lit("<!-- <title>old</title> --><title>new "), "page_id", F.lit("</title>")),
        F.concat(F.lit("<TITLE id='x'> &copy 2024 &#x41;&#233;&lt;b&gt; "), "page_id", F.lit("</TITLE >")),
        F.lit("<script>document.write('<title>no</title>')</script><title>after script</title>"),
        F.lit("<style>/* <title>no</title> */</style><!-- never closed <title>no</title>"),
        F.lit("<title>R&ampD &amp; more; &frac12;</title>"),
    ), (F.col("page_id").cast("long") % 5 + 1).cast("int"))
    made = pages.select("page_id", payload.title_element(F.concat(head, "html")).alias("element"))
    return made.select("page_id", payload.title_text(F.col("element")).alias("title"))


# ------------------------------------------------------------------ unions

_ALL = list(RAW_TYPES)
_FIRST = "source_file = 'page01.csv'"
_SECOND = "source_file = 'page02.csv'"


@query("union_by_name", f"""
SELECT id, name, price, NULL AS stars, category, source_file FROM products_raw WHERE {_FIRST}
UNION ALL BY NAME SELECT stars, price, id, source_file, category FROM products_raw WHERE {_SECOND}""")
def union_by_name(spark, sf_dir):
    raw = products_raw(spark, sf_dir)
    return ingest.union_by_name([
        raw.where(_FIRST).select("id", "name", "price", "category", "source_file"),
        raw.where(_SECOND).select("stars", "price", "id", "source_file", "category"),
    ])


@query("add_if_missing", f"""
SELECT id, category, 'brand#2' AS source_file FROM products_raw WHERE {_FIRST}
UNION ALL SELECT id, 'brand#2' AS category, source_file FROM products_raw WHERE {_SECOND}""")
def add_if_missing(spark, sf_dir):
    raw, name = products_raw(spark, sf_dir), ingest.stem(F.lit("brand#2.csv"))
    return ingest.union_by_name([
        ingest.with_missing_provenance(raw.where(_FIRST).select("id", "category"), name, name),
        ingest.with_missing_provenance(raw.where(_SECOND).select("id", "source_file"), name, name),
    ])


@query("merge_report", """
SELECT category, COUNT(*) AS "rows", GROUPING(category) AS total FROM products_raw GROUP BY ROLLUP (category)""")
def merge_report(spark, sf_dir):
    return ingest.merge_report(products_raw(spark, sf_dir))


# ------------------------------------------------- files out and in again

_BACK = f"CASE WHEN {_FIRST} THEN {{c}} END"
_ROUNDTRIP = ("id", "sku", "name", "brand_or_author", "stars", "badges_new", "price", "quantity_sold", "category")


@query("csv_scan_roundtrip", f"""
SELECT id, sku, name, brand_or_author, nullif(stars, '') AS stars, badges_new, price, quantity_sold,
  category, {_BACK.format(c='benefits_count')} AS benefits_count
FROM products_raw""")
def csv_scan_roundtrip(spark, sf_dir):
    """Category folders whose files differ in column order and columns."""
    raw, root = products_raw(spark, sf_dir), stage_path(spark, "crawl")
    sinks.write_by_category(raw.where(_FIRST).select(*_ROUNDTRIP, "benefits_count"), root, "csv")
    sinks.write_by_category(raw.where(_SECOND).select(*reversed(_ROUNDTRIP)), root, "csv", mode="append")
    back = ingest.merge_category_folders(spark, root)
    return back.select(*_ROUNDTRIP, "benefits_count")


@query("raw_folder_scan", """
SELECT id, name, price, category FROM products_raw""")
def raw_folder_scan(spark, sf_dir):
    """A raw folder of merged files."""
    raw, root = products_raw(spark, sf_dir), stage_path(spark, "raw")
    sinks.write_merged(raw.select("id", "name", "price", "category"), root, "csv")
    return ingest.merge_raw_files(spark, root).select("id", "name", "price", "category")


@query("charset_scan", """
SELECT CAST(p_partkey AS BIGINT) AS id, p_name || ' Đông "é", ü' AS name FROM part""")
def charset_scan(spark, sf_dir):
    """One half of the files in UTF-8, the other in Windows Vietnamese."""
    part, root = views.table(spark, sf_dir, "part"), stage_path(spark, "charsets")
    rows = part.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit(' Đông "é", ü')).alias("name"))
    switch = "spark.sql.legacy.javaCharsets"  # for writing; reading needs none
    before = spark.conf.get(switch, "false")
    spark.conf.set(switch, "true")
    for half, charset in enumerate(("UTF-8", "windows-1258")):
        chosen = rows.where(F.col("id") % 2 == half)
        options = {"header": True, "encoding": charset, "quote": '"', "escape": '"'}
        chosen.write.options(**options).csv(f"{root}/half{half}")
    spark.conf.set(switch, before)
    back = ingest.merge_category_folders(spark, root)
    return back.select(F.col("id").cast("bigint").alias("id"), "name")


_PRODUCT_SELECT = "SELECT id, name, category, price, quantity_sold, is_top_brand FROM products"
_PRODUCT_COLUMNS = ("id", "name", "category", "price", "quantity_sold", "is_top_brand")


@query("category_folder_sink", _PRODUCT_SELECT)
def category_folder_sink(spark, sf_dir):
    rows, path = products(spark, sf_dir).select(*_PRODUCT_COLUMNS), stage_path(spark, "by_category")
    sinks.write_by_category(rows, path)
    return spark.read.schema(rows.schema).parquet(path).select(*_PRODUCT_COLUMNS)


@query("table_replace", _PRODUCT_SELECT)
def table_replace(spark, sf_dir):
    rows, path = products(spark, sf_dir).select(*_PRODUCT_COLUMNS), stage_path(spark, "table")
    sinks.replace_table(rows.limit(0), "shelflens_products", path)
    sinks.replace_table(rows, "shelflens_products", path)
    return spark.table("shelflens_products")


# ------------------------------------------------------- what cannot be read

_PLAIN = "replace(name, ',', ' ')"
_LINE = f"id || ',\"' || {_PLAIN} || '\",' || sku"


@query("csv_rejects", f"""
SELECT id, {_PLAIN} AS name, sku, NULL AS reason, NULL AS record FROM products_raw
WHERE {_FIRST} AND CAST(id AS BIGINT) % 7 <> 0
UNION ALL
SELECT NULL, NULL, NULL, 'more fields than the header', {_LINE} || ',x' FROM products_raw
WHERE {_FIRST} AND CAST(id AS BIGINT) % 7 = 0""")
def csv_rejects(spark, sf_dir):
    """Rows of a folder some of whose lines have a field too many, and those lines."""
    root = stage_path(spark, "broken_csv")
    lines = products_raw(spark, sf_dir).where(_FIRST).select(F.expr(
        f"{_LINE} || CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN ',x' ELSE '' END"
    ).alias("id,name,sku"))
    # One column that no sign divides or quotes: the lines as they are.
    lines.write.options(header=True, sep="\u0001", quote="\u0002", escape="\u0002").csv(f"{root}/all")
    merged = ingest.category_folders(spark, root)
    rows = merged.rows.select("id", "name", "sku", F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("record"))
    return rows.unionByName(merged.rejects.select("reason", "record"), allowMissingColumns=True)


_CUT = "substring(detail, 1, length(detail) - 9)"


@query("payload_rejects", f"""
SELECT CAST(product_id AS VARCHAR) AS product_id, NULL AS record FROM payloads WHERE product_id % 6 <> 1
UNION ALL SELECT NULL, {_CUT} FROM payloads WHERE product_id % 6 = 1""")
def payload_rejects(spark, sf_dir):
    """Detail payloads of which some are cut short: those that can be read, and the text of the others."""
    path = stage_path(spark, "broken_detail")
    payloads(spark, sf_dir).select(
        F.expr(f"CASE WHEN product_id % 6 = 1 THEN {_CUT} ELSE detail END").alias("value")
    ).write.text(path)
    good = payload_files.read_detail(spark, path, mode="DROPMALFORMED").select("product_id", F.lit(None).cast("string").alias("record"))
    return good.unionByName(payload_files.payload_rejects(spark, path, DETAIL).select("record"), allowMissingColumns=True)


# ------------------------------------------------------ whole tables, back in


@query("enriched_roundtrip", _ENRICH)
def enriched_roundtrip(spark, sf_dir):
    """The enriched rows, written and read back."""
    path, rows = stage_path(spark, "enriched"), enrich_products(spark, sf_dir)
    sinks.write_merged(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query("folder_load", """
SELECT 'from_parquet' AS source, CAST(id AS VARCHAR) AS id, name, price FROM products WHERE id % 2 = 0
UNION ALL SELECT 'from_csv', CAST(id AS VARCHAR), name, price FROM products WHERE id % 2 = 1""")
def folder_load(spark, sf_dir):
    """Every table of a folder into the catalog: one of Parquet, one of CSV."""
    folder, rows = stage_path(spark, "tables"), products(spark, sf_dir).select("id", "name", "price")
    sinks.write_merged(rows.where("id % 2 = 0"), f"{folder}/from parquet")
    sinks.write_merged(rows.where("id % 2 = 1"), f"{folder}/from-csv", "csv")
    tables = load.load_folder(spark, folder)
    found = [spark.table(t).select(F.lit(t).alias("source"), F.col("id").cast("string").alias("id"), "name", "price") for t in tables]
    return ingest.union_by_name(found)
