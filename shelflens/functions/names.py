"""Features read from the product name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schema import NAME_KEYWORDS
from .text import SPACE, to_double

_SIZE = r"([0-9]+(?:\.[0-9]+)?)"


def _number(name: Column, pattern: str) -> Column:
    plain = F.replace(F.lower(name), F.lit(","), F.lit("."))
    return to_double(F.regexp_extract(plain, pattern, 1))


def storage_gb(name: Column) -> Column:
    """First terabyte size (times 1024), else first gigabyte size."""
    return F.coalesce(_number(name, _SIZE + SPACE + "*tb") * 1024, _number(name, _SIZE + SPACE + "*gb"))


def ram_gb(name: Column) -> Column:
    return _number(name, f"ram{SPACE}*" + _SIZE + SPACE + "*gb")


def inches(name: Column) -> Column:
    return _number(name, _SIZE + SPACE + '*(?:inch|inches|")')


def has_keyword(name: Column, word: str) -> Column:
    """1 where the word occurs anywhere in the name, case ignored; else 0."""
    return F.coalesce(F.lower(name).contains(word.lower()).cast("int"), F.lit(0))


def name_features(name: Column) -> dict[str, Column]:
    """All name features by column name."""
    features = {
        "name_storage_gb": storage_gb(name),
        "name_ram_gb": ram_gb(name),
        "name_inch": inches(name),
    }
    features.update({f"name_has_{word}": has_keyword(name, word) for word in NAME_KEYWORDS})
    return features
