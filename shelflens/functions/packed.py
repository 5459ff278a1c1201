"""Readers for the packed text columns (`k:v; k:v`, star counts, badges)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import BADGE_WORDS
from .text import SPACE, look_up, strip, to_integer


_BARE_SPACE = SPACE.replace(r"\s", r"\t\n\x0b\f\r")  # the same without the blank
# White space next to a delimiter, other than the one blank after a semicolon.
_ODD = rf"(?s)[;:](?:(?<={SPACE}.)|(?<=:)(?={SPACE})|(?<=;)(?= {SPACE}|{_BARE_SPACE}))"


def _entries_text(text: Column) -> Column:
    """`;k:v;k:v` without white space around entries, keys and values.

    Texts written by the packing functions need plain replacement only.  The
    patterns are kept for others: matching is what costs here.
    """
    bare = strip(text)
    plain = F.replace(bare, F.lit("; "), F.lit(";"))
    joined = F.regexp_replace(bare, rf"{SPACE}*;{SPACE}*", ";")
    tidied = F.regexp_replace(joined, rf"(^|;)([^;:]*?){SPACE}*:{SPACE}*", "$1$2:")
    # Printable ASCII without blanks has no white space: one quick look spares the other.
    odd = plain.rlike("[^!-~]") & bare.rlike(_ODD)
    return F.concat(F.lit(";"), F.when(odd, tidied).otherwise(plain))


def _kv_text(text: Column, key: str) -> Column:
    """Value of the last entry of `key`; empty text when there is none."""
    entries, lead = _entries_text(text), f";{key}:"
    last = F.substring_index(F.substring_index(entries, lead, -1), ";", 1)
    return F.when(entries.contains(lead), last).otherwise(F.lit(""))


def kv_value(text: Column, key: str) -> Column:
    """Value of `key` in `k:v; k:v` text, cut at the first colon of its entry.

    The last entry of a repeated key wins; null when absent or empty.
    """
    return F.nullif(_kv_text(text, key), F.lit(""))


def kv_entries(text: Column) -> Column:
    """All entries as `array<struct<k, v>>`; of a repeated key only the last."""
    parts = F.filter(F.split(text, ";"), lambda part: F.instr(part, ":") > 0)
    entries = F.transform(
        parts,
        lambda part: F.struct(
            strip(F.substring_index(part, ":", 1)).alias("k"),
            strip(F.regexp_replace(part, r"(?s)^[^:]*:", "")).alias("v"),
        ),
    )

    def last_of_each(es: Column) -> Column:
        later = lambda i: F.slice(es, i + 2, F.size(es))
        return F.filter(es, lambda e, i: ~F.exists(later(i), lambda other: other["k"] == e["k"]))

    # The one-element array binds the entries, which are then computed once.
    return F.element_at(F.transform(F.array(entries), last_of_each), 1)


def kv_flag(text: Column, key: str) -> Column:
    """Boolean entry; any other text (such as `None`) is null."""
    return look_up({"true": True, "false": False}, F.lower(_kv_text(text, key)))


def kv_number(text: Column, key: str) -> Column:
    """Numeric entry, thousands commas dropped; else null."""
    digits = strip(F.replace(_kv_text(text, key), F.lit(","), F.lit("")))
    return F.when(digits.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), digits.try_cast("double"))


def brand_id(text: Column) -> Column:
    """First number after `id:`."""
    return to_integer(F.regexp_extract(text, rf"\bid{SPACE}*:{SPACE}*([0-9]+)", 1))


def brand_name(text: Column) -> Column:
    """Everything after the first `name:`."""
    return F.nullif(strip(F.regexp_extract(strip(text), rf"\bname{SPACE}*:{SPACE}*(.+)$", 1)), F.lit(""))


def star_part(text: Column, level: int, part: str) -> Column:
    """`count` or `percent` of one star level; entries holding `None` do not count.

    Both parts come from one match, which is evaluated once per row.  The
    greedy prefix makes the last entry of the level win.
    """
    pair = rf"count_([0-9]+{SPACE}*,{SPACE}*percent_[0-9]+)"
    found = F.regexp_extract(text, rf"(?s)^(?:.*;)?{SPACE}*{level}{SPACE}*:{SPACE}*{pair}", 1)
    if part == "count":
        return to_integer(F.substring_index(found, ",", 1))
    return to_integer(F.substring_index(found, "percent_", -1))


def badge_flag(text: Column, suffix: str) -> Column:
    """Whether the badge word occurs as a whole word; false for null text."""
    return F.coalesce(text, F.lit("")).rlike(rf"\b{BADGE_WORDS[suffix]}\b")
