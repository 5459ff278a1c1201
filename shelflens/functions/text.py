"""Null tokens, trimming, text to number or boolean."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from ..schema import NULL_TOKENS

# ---- fixed values: white space of any script ----
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as a pattern: a plain class matches much faster than the Unicode flag.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Numbers as they are written in the files.  The pattern keeps forms only Java
# reads (`12d`, hexadecimal floats) from passing, and spares a cast that would
# fail: each failure costs an exception.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_DIGITS = r"^\s*[+-]?[0-9]+\s*$"

# Fails at the first character of any other text.
_TOKEN = rf"(?i)^{SPACE}*(?:" + "|".join(re.escape(token) for token in NULL_TOKENS if token) + rf")?{SPACE}*\z"


def strip(text: Column) -> Column:
    """Cut white space of any script from both ends (`trim` cuts blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def null_if_token(text: Column) -> Column:
    """Null where the text, white space and case aside, means "no value"; else unchanged."""
    return F.when(~text.rlike(_TOKEN), text)


def to_double(text: Column) -> Column:
    """Finite number or null."""
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    return F.nullif(F.nullif(number, F.lit(float("inf"))), F.lit(float("-inf")))


def to_integer(text: Column, type_name: str = "bigint") -> Column:
    """Whole number or null; accepts `16.0`, and keeps all digits of long ids."""
    return (
        F.when(text.rlike(_DIGITS), text.try_cast(type_name))
        .when(text.rlike(_NUMBER), text.try_cast("double").try_cast(type_name))
    )


def to_boolean(text: Column) -> Column:
    """True / false in any case (or 1 / 0), else null."""
    words = {"true": True, "1": True, "1.0": True, "false": False, "0": False, "0.0": False}
    return look_up(words, F.lower(strip(text)))


def look_up(words: dict, word: Column) -> Column:
    """Value of a word in a small fixed table; the word is computed once."""
    table = F.create_map(*[F.lit(part) for pair in words.items() for part in pair])
    return F.try_element_at(table, word)


def to_type(text: Column, type_name: str) -> Column:
    """Text to the clean type of its column."""
    if type_name == "double":
        return to_double(text)
    if type_name in ("bigint", "int"):
        return to_integer(text, type_name)
    if type_name == "boolean":
        return to_boolean(text)
    return text


def within(value: Column, low: float, high: float) -> Column:
    """Null outside `[low, high]`."""
    return F.when(value.between(low, high), value)
