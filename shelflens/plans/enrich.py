"""Landed listing, detail and review payloads into one row per listed product."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import payload, text
from ..schema import RAW_TYPES
from ..sources import payload_files

DETAIL_KEYS = ("product_id", "spid")
REVIEW_KEYS = ("product_id", "spid", "seller_id")
_DETAIL_FIELDS = (
    "tracking_info_amplitude", "inventory_status", "inventory_type", "data_version", "day_ago_created",
    "brand_or_author", "current_seller", "stock_item", "categories", "benefits_count",
)
_REVIEW_FIELDS = ("rating_average", "reviews_count", "stars")
# What a product without the payload shows: the fields of an empty object.
_EMPTY = {
    "tracking_info_amplitude": "", "brand_or_author": "", "current_seller": "", "stock_item": "",
    "categories": "", "benefits_count": 0, "stars": "",
}


def _keys(names: tuple[str, ...]):
    """Keys as whole numbers, however they are written, and the landing mark where there is one."""
    return [text.to_integer(F.col(c)).alias(c) for c in names]


def _landed(df: DataFrame) -> list[str]:
    return [payload_files.LANDED] if payload_files.LANDED in df.columns else []


def _whole(df: DataFrame):
    return F.struct(*[F.col(c) for c in df.columns])


def flatten_detail(details: DataFrame) -> DataFrame:
    """Detail payloads to packed columns, keys kept."""
    columns = {
        "tracking_info_amplitude": payload.tracking,
        "brand_or_author": payload.brand_or_author,
        "current_seller": payload.seller,
        "stock_item": payload.stock,
        "categories": lambda d: payload.category(d["categories"]),
        "benefits_count": lambda d: payload.benefits_count(d["benefits"]),
    }
    whole = _whole(details)
    plain = {c: text.to_type(F.col(c), RAW_TYPES[c]) for c in _DETAIL_FIELDS if c not in columns}
    return details.select(
        *_keys(DETAIL_KEYS), *_landed(details),
        *[(columns[c](whole) if c in columns else plain[c]).alias(c) for c in _DETAIL_FIELDS],
    )


def flatten_review(reviews: DataFrame) -> DataFrame:
    """Review payloads to rating, count and packed stars, keys kept."""
    whole = _whole(reviews)
    rating, count = payload.rating_pair(whole)
    return reviews.select(
        *_keys(REVIEW_KEYS), *_landed(reviews),
        rating.alias("rating_average"),
        count.alias("reviews_count"),
        payload.stars(whole).alias("stars"),
    )


def flatten_listing(items: DataFrame) -> DataFrame:
    """Listed items with clean types; badges stay JSON text."""
    def field(name):
        if name == "quantity_sold":
            return payload.sold_quantity(F.col(name))
        return text.to_type(F.col(name), RAW_TYPES[name])

    return items.select(*[field(c).alias(c) for c in RAW_TYPES if c in items.columns])


def with_match_keys(df: DataFrame, keys: tuple[str, ...], prefix: str) -> DataFrame:
    """Two columns per key that match null-safe by plain equality: value or 0, and whether known.

    Grouping and joining by the same columns needs one shuffle, not two.
    """
    return df.withColumns({
        name: column for i, key in enumerate(keys) for name, column in (
            (f"{prefix}{i}", F.coalesce(F.col(key), F.lit(0))), (f"{prefix}{i}_known", F.col(key).isNotNull()),
        )
    })


def match_names(keys: tuple[str, ...], prefix: str) -> list[str]:
    return [f"{prefix}{i}{tail}" for i in range(len(keys)) for tail in ("", "_known")]


def one_per_key(df: DataFrame, keys: tuple[str, ...], prefix: str) -> DataFrame:
    """One row per key, under its match columns: a payload landed twice must not double its product.

    The one landed last wins where that is known, else the largest row.  The
    choice is cut down in the map tasks, so a hot key costs one row per task.
    That sorts what a task holds, and a small compressed file can unfold into
    many wide rows: they are dealt out by their content first.
    """
    rest = [c for c in df.columns if c not in (*keys, payload_files.LANDED)]
    names = match_names(keys, prefix)
    newest = [F.col(c).desc() for c in _landed(df)]
    order = Window.partitionBy(*names).orderBy(*newest, F.struct(*rest).desc())
    dealt = df.repartition(F.xxhash64(*df.columns))
    placed = with_match_keys(dealt, keys, prefix).withColumn("_place", F.row_number().over(order))
    return placed.where("_place = 1").select(*names, *rest)


def enrich(items: DataFrame, details: DataFrame, reviews: DataFrame) -> DataFrame:
    """Join flattened detail and review fields to the listed products.

    Payloads are flattened first, so the joins move a few short columns.  Keys
    are compared null-safe, as product and seller ids may be missing; a product
    without a payload is kept and shows empty fields.
    """
    detail = one_per_key(flatten_detail(details), DETAIL_KEYS, "_d")
    review = one_per_key(flatten_review(reviews), REVIEW_KEYS, "_r")
    listed = flatten_listing(items)
    offer = ("id", "seller_product_id", "seller_id")
    keyed = with_match_keys(with_match_keys(listed, offer[:2], "_d"), offer, "_r")
    joined = keyed.join(detail, match_names(DETAIL_KEYS, "_d"), "left").join(
        review, match_names(REVIEW_KEYS, "_r"), "left"
    )
    known = set(joined.columns)
    empty = {c: F.coalesce(F.col(c), F.lit(value)) for c, value in _EMPTY.items()}
    return joined.select(*[empty.get(c, F.col(c)).alias(c) for c in RAW_TYPES if c in known])
