"""Flattening of detail, review and listing payloads into packed text columns."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from ..schema import (
    AMPLITUDE_KEYS, BRAND_KEYS, CATEGORY_KEYS, SELLER_KEYS, STAR_LEVELS, STOCK_ITEM_KEYS,
)
from .text import strip, to_double, to_integer


def let(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shown(value: Column) -> Column:
    """A JSON scalar the way the files spell it: `True`, `False`, `None`."""
    return (
        F.when(value.isNull(), F.lit("None"))
        .when(value == "true", F.lit("True"))
        .when(value == "false", F.lit("False"))
        .otherwise(value)
    )


def pack(pairs: Sequence[tuple[str, Column]]) -> Column:
    """`k:v; k:v`."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{k}:"), shown(v)) for k, v in pairs])


def pack_object(obj: Column, keys: Sequence[str]) -> Column:
    """The named keys of an object; empty text where there is no object."""
    return F.when(obj.isNotNull(), pack([(k, obj[k]) for k in keys])).otherwise(F.lit(""))


def tracking(detail: Column) -> Column:
    return pack_object(detail["tracking_info"]["amplitude"], AMPLITUDE_KEYS)


def seller(detail: Column) -> Column:
    return pack_object(detail["current_seller"], SELLER_KEYS)


def stock(detail: Column) -> Column:
    return pack_object(detail["stock_item"], STOCK_ITEM_KEYS)


_AUTHOR = ", ".join(f"{c} string" for c in BRAND_KEYS)


def brand_or_author(detail: Column) -> Column:
    """Authors where any are listed, else the brand, else empty text."""
    # Each element is text of its own: one that is no object does not spoil the list.
    authors = F.transform(
        F.filter(detail["authors"], _is_object), lambda a: F.from_json(a, _AUTHOR)
    )

    def joined(field: str, glue: str, usable) -> Column:
        texts = F.filter(F.transform(authors, lambda a: a[field]), usable)
        return F.when(F.size(texts) > 0, F.array_join(texts, glue))

    authored = pack([
        ("id", joined("id", ",", lambda v: v.isNotNull())),
        ("name", joined("name", ", ", lambda v: v.isNotNull() & (v != ""))),
    ])
    return F.when(F.size(detail["authors"]) > 0, authored).otherwise(pack_object(detail["brand"], BRAND_KEYS))


def _is_object(text: Column) -> Column:
    return F.ltrim(text).startswith("{")


def _is_list(text: Column) -> Column:
    return F.ltrim(text).startswith("[")


def category(text: Column) -> Column:
    """A category object, or the last one of a list of them; else empty text."""
    fields = ", ".join(f"{k} STRING" for k in CATEGORY_KEYS)
    leaf = F.when(_is_object(text), text).when(
        _is_list(text),
        F.try_element_at(F.from_json(text, "array<string>"), F.lit(-1)),
    )
    parsed = let(leaf, lambda item: F.when(_is_object(item), F.from_json(item, fields)))
    return let(parsed, lambda obj: pack_object(obj, CATEGORY_KEYS))


def benefits_count(text: Column) -> Column:
    """Items of a list or keys of an object; 0 for anything else."""
    return (
        F.when(_is_list(text), F.json_array_length(text))
        .when(_is_object(text), F.size(F.json_object_keys(text)))
        .otherwise(F.lit(0))
    )


def rating_pair(review: Column) -> tuple[Column, Column]:
    """Rating average and review count.

    The summary is looked at only when one of the two is missing, and then a
    zero counts as missing as well.
    """
    def numbers(of: Column) -> tuple[Column, Column]:
        return to_double(of["rating_average"]), to_integer(of["reviews_count"])

    summary = review["rating_summary"]
    top, below = numbers(review), numbers(summary)
    consult = summary.isNotNull() & (top[0].isNull() | top[1].isNull())

    def pick(value: Column, fallback: Column) -> Column:
        return F.when(consult & (value.isNull() | (value == 0)), fallback).otherwise(value)

    return pick(top[0], below[0]), pick(top[1], below[1])


def stars(review: Column) -> Column:
    """`1:count_c,percent_p;...` from the star object, the summary's as fallback."""
    top = review["stars"]
    source = F.when(_is_object(top), top).otherwise(review["rating_summary"]["stars"])
    by_level = F.from_json(F.when(_is_object(source), source), "map<string,string>")

    def from_object(level: int, parsed: Column) -> Column:
        count, percent = parsed["count"], parsed["percent"]
        packed = F.concat(F.lit(f"{level}:count_"), shown(count), F.lit(",percent_"), shown(percent))
        return F.when(count.isNotNull() | percent.isNotNull(), packed)

    def entry(level: int, value: Column) -> Column:
        number = F.when(value.rlike(r"^-?[0-9.]+([eE][+-]?[0-9]+)?$"), value.try_cast("double"))
        empty = value.isin("", "false", "[]") | (number == 0)
        return (
            F.when(
                _is_object(value),
                let(F.from_json(value, "count STRING, percent STRING"), lambda o: from_object(level, o)),
            )
            .when(
                value.isNotNull() & ~F.coalesce(empty, F.lit(False)),
                F.concat(F.lit(f"{level}:count_"), shown(value), F.lit(",percent_None")),
            )
        )

    def of_level(levels: Column, level: int) -> Column:
        return let(F.try_element_at(levels, F.lit(str(level))), lambda value: entry(level, value))

    def entries(levels: Column) -> Column:
        return F.concat_ws(";", *[of_level(levels, level) for level in STAR_LEVELS])

    return let(by_level, entries)


def sold_quantity(text: Column) -> Column:
    """The number itself, or the `value` of an object."""
    return to_double(F.when(_is_object(text), F.get_json_object(text, "$.value")).otherwise(text))


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


# What a browser takes no element from: comments, and the text of scripts and styles.
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
_TITLE = r"(?is)<title(?:\s[^>]*)?>.*?</title\s*>"


def title_element(page: Column) -> Column:
    """The first `<title>` element outside comments, scripts and styles; empty text when there is none."""
    bare = F.when(page.contains("<!--") | page.rlike("(?i)<(?:script|style)"), F.regexp_replace(page, _NO_MARKUP, " "))
    return F.regexp_extract(F.coalesce(bare, page), _TITLE, 0)


def title_text(element: Column) -> Column:
    """Text of a title element, entities decoded as HTML does; `No title` for none.

    Only titles that hold an entity are handed to Python.
    """
    text = F.regexp_replace(element, r"(?i)^<title[^>]*>|</title\s*>\z", "")
    plain = F.coalesce(_unescape(F.when(text.contains("&"), text)), text)
    return F.when(element.isNull() | (element == ""), F.lit("No title")).otherwise(strip(plain))


def page_title(page: Column) -> Column:
    """Title of a page.  Over a table, take `title_element` in a step of its own: it is then found once."""
    return title_text(title_element(page))


def page_preview(page: Column, length: int = 5000) -> Column:
    """The first characters of a page, for a look at what came back."""
    return F.substring(page, 1, length)
