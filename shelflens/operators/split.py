"""Train, test and holdout rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# ---- fixed values: holdout share of all rows, test share of the others ----
HOLDOUT_SHARE, TEST_SHARE = 0.30, 0.20


def bucket(key: Column, salt: str = "", buckets: int = 10_000) -> Column:
    """Number below `buckets` from the key's digest: same row, same number, on any cluster."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def split_part(key: Column, holdout: float = HOLDOUT_SHARE, test: float = TEST_SHARE) -> Column:
    """`holdout`, `test` or `train`; the second cut is salted to be independent of the first."""
    return (
        F.when(bucket(key) < round(holdout * 10_000), F.lit("holdout"))
        .when(bucket(key, "|dev") < round(test * 10_000), F.lit("test"))
        .otherwise(F.lit("train"))
    )
