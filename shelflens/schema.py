"""Column lists and Spark types of the product tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: product columns in their stored order, with clean types ----
RAW_TYPES: dict[str, str] = {
    "id": "bigint",
    "sku": "string",
    "name": "string",
    "seller_product_id": "bigint",
    "seller_id": "bigint",
    "tracking_info_amplitude": "string",
    "inventory_status": "string",
    "inventory_type": "string",
    "data_version": "bigint",
    "day_ago_created": "bigint",
    "brand_or_author": "string",
    "current_seller": "string",
    "stock_item": "string",
    "categories": "string",
    "benefits_count": "int",
    "rating_average": "double",
    "reviews_count": "bigint",
    "stars": "string",
    "productset_id": "bigint",
    "primary_category_path": "string",
    "price": "bigint",
    "original_price": "bigint",
    "discount": "bigint",
    "discount_rate": "double",
    "favourite_count": "bigint",
    "badges_new": "string",
    "badges_v3": "string",
    "quantity_sold": "double",
    "product_reco_score": "double",
    "availability": "int",
    "shippable": "boolean",
    "category": "string",
    "source_file": "string",
}

# ---- fixed values: texts that mean "no value" ----
NULL_TOKENS = ("", "none", "null", "nan", "n/a", "na", "-", "..")

# ---- fixed values: columns whose text is trimmed ----
TRIMMED_COLUMNS = ("name", "category", "inventory_status", "inventory_type")

# ---- fixed values: keys read from the packed columns ----
TRACKING_FLAGS = ("is_authentic", "is_freeship_xtra", "is_top_brand", "is_hero")
STOCK_KEYS = ("qty", "min_sale_qty", "max_sale_qty")
STAR_LEVELS = (1, 2, 3, 4, 5)

# ---- fixed values: badge word searched for, by flag suffix ----
BADGE_WORDS = {
    "has_video_badge": "video_icon",
    "has_authentic_badge": "authentic_brand",
    "has_variant_count_badge": "variant_count",
    "has_delivery_badge": "delivery_info_badge",
}

# ---- fixed values: valid ranges; anything outside becomes null ----
VALID_RANGES = {"discount_rate": (0.0, 100.0), "rating_average": (0.0, 5.0)}

# ---- fixed values: left out when screening features against price ----
SCREENING_EXCLUDED = (
    "original_price", "discount", "discount_rate",
    "id", "sku", "seller_product_id", "seller_id",
    "brand_id", "data_version", "source_file",
    "tracking_info_amplitude", "stock_item",
    "badges_new", "badges_v3",
)

# ---- fixed values: words looked for in a product name ----
NAME_KEYWORDS = ("pro", "plus", "ultra", "max", "combo", "set", "pack")

NAME_FEATURES = ("name_storage_gb", "name_ram_gb", "name_inch") + tuple(
    f"name_has_{word}" for word in NAME_KEYWORDS
)

# ---- fixed values: inputs of the price model ----
MODEL_FEATURES = (
    "primary_category_path", "brand_or_author", "brand_name", "categories", "category",
    "reviews_count", "log_quantity_sold", "badges_new_has_authentic_badge", "rating_average",
    "star_5_percent", "star_4_percent", "star_3_percent", "star_2_percent", "star_1_percent",
    "badges_new_has_delivery_badge", "is_top_brand",
    "name", "current_seller",
) + NAME_FEATURES


def text_schema(columns: list[str]) -> T.StructType:
    """All-string schema: CSV is read as text and typed once, in the clean step."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# Landed payloads.  Fields that arrive in more than one shape (object or list,
# object or number) are kept as their JSON text and told apart when flattened.
LISTING_ITEM = T.StructType([
    T.StructField(c, T.StringType()) for c in (
        "id", "sku", "name", "seller_product_id", "seller_id", "productset_id",
        "primary_category_path", "price", "original_price", "discount", "discount_rate",
        "favourite_count", "badges_new", "badges_v3", "quantity_sold",
        "product_reco_score", "availability", "shippable",
    )
])
LISTING_PAGE = T.StructType([
    T.StructField("page", T.StringType()),
    T.StructField("data", T.ArrayType(LISTING_ITEM)),
])
# The same pages, items unread: only how many there are.
LISTING_LENGTHS = T.StructType([
    T.StructField("page", T.StringType()),
    T.StructField("data", T.ArrayType(T.StructType([T.StructField("id", T.StringType())]))),
])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# ---- fixed values: payload objects and the order their keys are packed in ----
AMPLITUDE_KEYS = ("is_authentic", "is_freeship_xtra", "is_hero", "is_top_brand", "return_reason")
SELLER_KEYS = ("id", "sku", "name", "store_id", "is_best_store", "is_offline_installment_supported")
STOCK_ITEM_KEYS = ("max_sale_qty", "min_sale_qty", "qty")
CATEGORY_KEYS = ("id", "name", "is_leaf")
BRAND_KEYS = ("id", "name")

# Numbers are read as text: `3300.0` and `"12"` are whole numbers too, and are converted where they are used.
DETAIL = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("spid", T.StringType()),
    T.StructField("tracking_info", T.StructType([
        T.StructField("amplitude", _texts(*AMPLITUDE_KEYS)),
    ])),
    T.StructField("inventory_status", T.StringType()),
    T.StructField("inventory_type", T.StringType()),
    T.StructField("data_version", T.StringType()),
    T.StructField("day_ago_created", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("brand", _texts(*BRAND_KEYS)),
    T.StructField("current_seller", _texts(*SELLER_KEYS)),
    T.StructField("stock_item", _texts(*STOCK_ITEM_KEYS)),
    T.StructField("categories", T.StringType()),
    T.StructField("benefits", T.StringType()),
])

REVIEW = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("spid", T.StringType()),
    T.StructField("seller_id", T.StringType()),
    T.StructField("rating_average", T.StringType()),
    T.StructField("reviews_count", T.StringType()),
    T.StructField("stars", T.StringType()),
    T.StructField("rating_summary", T.StructType([
        T.StructField("rating_average", T.StringType()),
        T.StructField("reviews_count", T.StringType()),
        T.StructField("stars", T.StringType()),
    ])),
])
