"""From merged raw text to the clean product table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions import packed, text
from ..operators.dedup import best_row_per_id, ranking_columns
from ..operators.ordered import exact_quantile
from ..schema import (
    BADGE_WORDS, RAW_TYPES, STAR_LEVELS, STOCK_KEYS, TRACKING_FLAGS, TRIMMED_COLUMNS, VALID_RANGES, text_schema,
)

BEST_SELLER_QUANTILE = 0.8


def null_tokens_to_null(df: DataFrame) -> DataFrame:
    """Null tokens to null in every text column."""
    return df.select([
        text.null_if_token(F.col(f.name)).alias(f.name) if f.dataType == StringType() else F.col(f.name)
        for f in df.schema.fields
    ])


def type_columns(df: DataFrame) -> DataFrame:
    """Text to clean types; listed text columns are trimmed."""
    def typed(field):
        column = F.col(field.name)
        target = RAW_TYPES.get(field.name, "string")
        if field.dataType != StringType():
            return column if target == "string" else column.try_cast(target)
        if field.name in TRIMMED_COLUMNS:
            return text.strip(column)
        return text.to_type(column, target)

    return df.select([typed(f).alias(f.name) for f in df.schema.fields])


def derived_columns(columns: list[str]) -> dict:
    """Columns read out of the packed texts, for those that are present."""
    out = {}
    if "brand_or_author" in columns:
        out["brand_id"] = packed.brand_id(F.col("brand_or_author"))
        out["brand_name"] = packed.brand_name(F.col("brand_or_author"))
    if "tracking_info_amplitude" in columns:
        for flag in TRACKING_FLAGS:
            out[flag] = packed.kv_flag(F.col("tracking_info_amplitude"), flag)
    if "stock_item" in columns:
        for key in STOCK_KEYS:
            out[f"stock_{key}"] = packed.kv_number(F.col("stock_item"), key)
    if "stars" in columns:
        for level in STAR_LEVELS:
            for part in ("count", "percent"):
                out[f"star_{level}_{part}"] = packed.star_part(F.col("stars"), level, part)
    for badges in ("badges_new", "badges_v3"):
        if badges in columns:
            for suffix in BADGE_WORDS:
                out[f"{badges}_{suffix}"] = packed.badge_flag(F.col(badges), suffix)
    return out


def parse_packed(df: DataFrame) -> DataFrame:
    """Add the derived columns."""
    return df.withColumns(derived_columns(df.columns))


def drop_out_of_range(df: DataFrame) -> DataFrame:
    """Null for discount rates and ratings outside their range."""
    return df.withColumns({
        c: text.within(F.col(c), low, high) for c, (low, high) in VALID_RANGES.items() if c in df.columns
    })


def add_sales_targets(df: DataFrame, quantities: DataFrame | None = None) -> DataFrame:
    """`log_quantity_sold`, and `best_seller`: at or above the 0.8 quantile.

    The flag is null where nothing is known about sales.  The quantile is that
    of `quantities` (column `quantity_sold`), by default of `df` itself.
    """
    if "quantity_sold" not in df.columns:
        return df
    sold = F.col("quantity_sold")
    known = (df if quantities is None else quantities).select("quantity_sold")
    threshold = exact_quantile(known, "quantity_sold", BEST_SELLER_QUANTILE)
    return df.withColumns({
        "log_quantity_sold": F.log1p(sold),
        "best_seller": sold >= threshold.scalar(),
    })


def clean_rows(raw: DataFrame) -> DataFrame:
    """Every step that looks at one row only; no shuffle."""
    return drop_out_of_range(parse_packed(type_columns(null_tokens_to_null(raw))))


def clean_products(raw: DataFrame) -> DataFrame:
    """Clean rows, best row per id, sales targets; original columns first.

    The quantile comes from a pass over the few columns that decide which row
    of an id stays; the wide rows are cleaned, shuffled and written once.  `raw`
    is read twice (those columns, then all): pass a table, not a long plan.
    """
    rows = clean_rows(raw)
    if "id" not in rows.columns:
        return add_sales_targets(rows)
    narrow = clean_rows(raw.select(*ranking_columns(raw)))
    return add_sales_targets(best_row_per_id(rows), best_row_per_id(narrow))


def clean_types(columns: list[str]) -> dict[str, str]:
    """Types of a clean table's columns, from the names of those it has."""
    rows = clean_rows(SparkSession.active().createDataFrame([], text_schema([c for c in columns if c in RAW_TYPES])))
    return {**dict(rows.dtypes), "log_quantity_sold": "double", "best_seller": "boolean"}


def typed(table: DataFrame) -> DataFrame:
    """A clean table that came as text (CSV), with the types it had; unknown columns stay text."""
    types = clean_types(table.columns)
    return table.select(*[text.to_type(F.col(c), types.get(c, "string")).alias(c) for c in table.columns])
