"""Landed JSON payloads, read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text
from ..schema import DETAIL, LISTING_LENGTHS, LISTING_PAGE, REVIEW
from .csv_files import decoded


LANDED = "_landed"  # when and in which file a payload landed: the later of two wins


_BROKEN = "_broken"


def _read(spark: SparkSession, path: str, schema, mode: str, multi_line: bool) -> DataFrame:
    """Payloads of a folder.

    By default text that is not JSON fails the job (`mode`: `DROPMALFORMED`
    leaves it out; `payload_rejects` then tells what was left out).  One payload
    per line, or with `multi_line` one document per file.
    """
    rows = spark.read.schema(schema).options(mode=mode, multiLine=multi_line).json(path)
    return rows.withColumn(LANDED, F.struct("_metadata.file_modification_time", "_metadata.file_path"))


def payload_rejects(spark: SparkSession, path: str, schema, multi_line: bool = False) -> DataFrame:
    """Payloads that are not JSON: `file_path`, `record` (the text), `readable` (what could be read of it, as JSON)."""
    whole = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    texts = spark.read.text(path, wholetext=multi_line)
    rows = texts.select(
        decoded(F.col("_metadata.file_path")).alias("file_path"), "value", F.from_json("value", whole, options).alias("p")
    )
    readable = F.to_json(F.struct(*[F.col("p")[f.name].alias(f.name) for f in schema.fields]))
    # A list of payloads is read as one row each.
    listed = F.ltrim("value").startswith("[") & F.from_json("value", T.ArrayType(schema)).isNotNull()
    return rows.where(F.col("p")[_BROKEN].isNotNull() & ~listed).select(
        "file_path", F.col("value").alias("record"), readable.alias("readable")
    )


def read_listing(
    spark: SparkSession, path: str, first_page: int = 1, last_page: int | None = None,
    mode: str = "FAILFAST", multi_line: bool = False,
) -> DataFrame:
    """Listed products of the pages from `first_page` up to the first empty one.

    Pages after an empty one are left out, as a crawl stops there: a first read
    counts the items of each page without taking them apart.
    """
    counted = _read(spark, path, LISTING_LENGTHS, mode, multi_line)
    pages = _read(spark, path, LISTING_PAGE, mode, multi_line)
    return listed_items(pages, first_page, last_page, counted)


def listed_items(
    pages: DataFrame, first_page: int = 1, last_page: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """One row per listed product: `page` and the item's fields.

    `counted`: the pages again, with as little of their items as tells how many there are.
    """

    def wanted(some: DataFrame) -> DataFrame:
        numbered = some.withColumn("page", text.to_integer(F.col("page").cast("string"))).where(F.col("page") >= first_page)
        return numbered if last_page is None else numbered.where(F.col("page") <= last_page)

    items = F.coalesce(F.size("data"), F.lit(0))
    per_page = wanted(pages if counted is None else counted).groupBy("page").agg(F.max(items).alias("items"))
    stop = per_page.where("items = 0").agg(F.min("page")).scalar()
    kept = wanted(pages).where(F.isnull(stop) | (F.col("page") < stop))
    return kept.select("page", F.inline("data"))


def read_detail(spark: SparkSession, path: str, mode: str = "FAILFAST", multi_line: bool = False) -> DataFrame:
    """Detail payloads, keyed by `product_id`, `spid`."""
    return _read(spark, path, DETAIL, mode, multi_line)


def read_review(spark: SparkSession, path: str, mode: str = "FAILFAST", multi_line: bool = False) -> DataFrame:
    """Review payloads, keyed by `product_id`, `spid`, `seller_id`."""
    return _read(spark, path, REVIEW, mode, multi_line)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Web pages, one row each (`url`, `html`)."""
    return spark.read.parquet(path)
