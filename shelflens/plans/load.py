"""A folder of files as tables: one per Parquet or CSV file, or folder of such files."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import sinks
from ..sources.csv_files import FILE_NAME, FILE_PATH, read_files
from . import clean

FORMS = (".parquet", ".csv")


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or the CSV files of a folder, with the types of a clean table where columns are named like its own."""
    files = read_files(spark, path if path.lower().endswith(".csv") and not _children(spark, path) else f"{path}/*.csv")
    return clean.typed(files.rows().drop(FILE_PATH, FILE_NAME))


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


_READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {".parquet": _read_parquet, ".csv": read_csv_table}


def _children(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Name and path of what lies in a folder; empty for a file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        raise FileNotFoundError(path)
    if files.getFileStatus(at).isFile():
        return []
    found = ((s.getPath().getName(), s.getPath().toUri().getPath()) for s in files.listStatus(at))
    return sorted((name, f"{path.rstrip('/')}/{name}") for name, _ in found if name[0] not in "._")


def _form(spark: SparkSession, name: str, path: str) -> str | None:
    """By the entry's own ending, else by that of the first file in it."""
    for form in FORMS:
        if name.lower().endswith(form):
            return form
    inside = (form for child, _ in _children(spark, path) for form in FORMS if child.lower().endswith(form))
    return next(inside, None)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by what lies there: CSV files are typed, anything else is read as Parquet."""
    form = _form(spark, path.rstrip("/").rsplit("/", 1)[-1], path) or ".parquet"
    return _READERS[form](spark, path)


def folder_tables(spark: SparkSession, folder: str) -> dict[str, tuple[str, str]]:
    """Table name to path and form of everything in `folder` that is a table.

    The name is the file's without its ending; signs a table name cannot hold become `_`.
    """
    tables: dict[str, tuple[str, str]] = {}
    for name, path in _children(spark, folder):
        form = _form(spark, name, path)
        if form is None:
            continue
        stem = name[: -len(form)] if name.lower().endswith(form) else name
        table = re.sub(r"\W+", "_", stem, flags=re.ASCII).lower()
        if table in tables:
            raise ValueError(f"{tables[table][0]} and {path} would both be table {table}")
        tables[table] = path, form
    if not tables:
        raise FileNotFoundError(f"no Parquet or CSV table in {folder}")
    return tables


def load_folder(spark: SparkSession, folder: str, url: str | None = None) -> list[str]:
    """Replace one table per entry of the folder, in the catalog or through JDBC; the tables' names.

    In the catalog all are written under new names first and take their places
    when the last one is there: a failing entry leaves every old table as it was.
    """
    tables = folder_tables(spark, folder)
    frames = {name: _READERS[form](spark, path) for name, (path, form) in tables.items()}
    if url is not None:
        sinks.load_database(frames, url)
        return list(frames)
    fresh = {name: f"{name}__new" for name in frames}
    try:
        for name, frame in frames.items():
            sinks.replace_table(frame, fresh[name])
    except Exception:
        for name in fresh.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    for name, new in fresh.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    return list(frames)
