"""CSV folders into one raw table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.csv_files import FILE_NAME, FILE_PATH, CsvFiles, decoded, read_files

MERGED_NAME = "all_categories"  # fixed value: merged files left out of a raw folder


@dataclass(frozen=True)
class Merged:
    """The merged rows, and the records that do not fit their file's header (`file_path`, `reason`, `record`)."""

    rows: DataFrame
    rejects: DataFrame
    files: CsvFiles

    def counts(self) -> DataFrame:
        """`reason` (null: the rows), `n`: what was counted while the rows were written; no file is read for it."""
        found = [(None if name == "rows" else name, n) for name, n in self.files.counts().items()]
        return self.rows.sparkSession.createDataFrame(found, "reason string, n long")


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """All rows; first frame's columns, then unseen ones as met, missing ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _folder() -> Column:
    """Name of the file's folder; `column=` of a partition folder is dropped."""
    name = F.try_element_at(F.split(decoded(F.col(FILE_PATH)), "/"), F.lit(-2))
    return F.regexp_replace(name, r"^(category|folder)=", "")


def with_provenance(df: DataFrame, category: Column, source_file: Column) -> DataFrame:
    """Set `category` and `source_file`, replacing what the file itself says."""
    return df.withColumns({"category": category, "source_file": source_file})


def with_missing_provenance(df: DataFrame, category: Column, source_file: Column) -> DataFrame:
    """Add `category` and `source_file` only where the file has no such column."""
    wanted = {"category": category, "source_file": source_file}
    return df.withColumns({c: value for c, value in wanted.items() if c not in df.columns})


def stem(file_name: Column) -> Column:
    """File name without `.csv`."""
    return F.regexp_replace(file_name, r"(?i)\.csv$", "")


def _rows(files: CsvFiles, category: Column, source_file: Column, keep_own: bool) -> DataFrame:
    """All records that fit, with `category` and `source_file`.

    They come after the columns of the first file unless that has them, as if its rows were the first of a union.
    """
    wanted = {"category": category, "source_file": source_file}
    columns = list(dict.fromkeys([*files.headers[0], *wanted, *files.columns]))

    def value(c: str) -> Column:
        if c not in wanted:
            return files.value(c)
        return F.when(files.has(c), files.value(c)).otherwise(wanted[c]) if keep_own else wanted[c]

    return files.good().select(*[value(c).alias(c) for c in columns])


def category_folders(spark: SparkSession, root: str) -> Merged:
    """All CSV files of all category folders below `root`; folders without any add nothing."""
    files = read_files(spark, f"{root}/*/*.csv")
    return Merged(_rows(files, _folder(), decoded(F.col(FILE_NAME)), keep_own=False), files.rejects(), files)


def raw_files(spark: SparkSession, root: str) -> Merged:
    """All CSV files in `root` and in the folders per category that `write_by_category` makes below it.

    Merged files of an earlier run are left out.  A file's own `category` wins,
    so names that a path has to escape come back as they were.
    """
    files = read_files(spark, f"{root}/{{*.csv,folder=*/*.csv}}", leave_out=MERGED_NAME)
    name = decoded(F.col(FILE_NAME))
    return Merged(_rows(files, stem(name), name, keep_own=True), files.rejects(), files)


def merge_category_folders(spark: SparkSession, root: str) -> DataFrame:
    """The rows of `category_folders`."""
    return category_folders(spark, root).rows


def merge_raw_files(spark: SparkSession, root: str) -> DataFrame:
    """The rows of `raw_files`."""
    return raw_files(spark, root).rows


def merge_report(df: DataFrame) -> DataFrame:
    """Rows per category and, flagged, in total with the number of categories."""
    return (
        df.rollup("category")
        .agg(F.count(F.lit(1)).alias("rows"), F.grouping("category").cast("int").alias("total"))
        .orderBy("total", F.col("category").asc_nulls_last())
    )
