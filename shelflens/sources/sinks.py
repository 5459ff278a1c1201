"""Where results go: Parquet or CSV folders, and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BOM = "\ufeff"


def _rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of one key together, in tasks of even size: a hot key gets several."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_by_category(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    """One folder per category, with few files in each however many tasks wrote them.

    CSV files keep the category as a column too, so that each stands alone.
    """
    if form == "csv":
        folders = _rebalanced(df.withColumn("folder", F.col("category")), "folder")
        _csv_writer(folders, keep=("folder",), mode=mode).partitionBy("folder").csv(path)
    else:
        _rebalanced(df, "category").write.mode(mode).partitionBy("category").parquet(path)


def write_merged(df: DataFrame, path: str, form: str = "parquet", mode: str = "overwrite") -> None:
    """One folder for the whole table; as many files as there are tasks."""
    if form == "csv":
        _csv_writer(df, mode=mode).csv(path)
    else:
        df.write.mode(mode).parquet(path)


def _csv_writer(df: DataFrame, keep: tuple[str, ...] = (), mode: str = "overwrite"):
    """CSV with header and UTF-8 byte order mark, quotes doubled."""
    first = next(c for c in df.columns if c not in keep)
    marked = df.withColumnRenamed(first, BOM + first)
    return marked.write.mode(mode).options(
        header=True, quote='"', escape='"', encoding="UTF-8", emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a catalog table by `df`."""
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def database_options(url: str, table: str, connections: int = 32) -> dict[str, str]:
    """Options to replace a database table through JDBC; column types are those of Spark's dialect for the url.

    For SQL Server text becomes NVARCHAR(MAX).  `connections` bounds how many tasks write at a time.
    """
    return {"url": url, "dbtable": table, "numPartitions": str(connections), "batchsize": "10000"}


def load_database(tables: dict[str, DataFrame], url: str, **options: str) -> None:
    """Replace one database table per entry."""
    for name, df in tables.items():
        df.write.format("jdbc").options(**database_options(url, name), **options).mode("overwrite").save()


def load_tables(spark: SparkSession, folder_tables: dict[str, str]) -> None:
    """Replace one catalog table per Parquet folder."""
    for name, path in folder_tables.items():
        replace_table(spark.read.parquet(path), name)
