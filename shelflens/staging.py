"""Intermediate tables on shared storage.

A staged table is written once and read many times: it cuts the lineage, lets
each reader prune columns, and outlives any executor.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_made: set[str] = set()
_paths: dict[int, str] = {}


def stage_root(spark: SparkSession) -> str:
    """Folder for this application's staged tables.

    It lies below the cluster's checkpoint folder or, where none is named, below
    the warehouse.  A warehouse on a machine's own disk serves a local session
    only: executors elsewhere would not find what others wrote.  The JVM deletes
    the folder through its own file system when the application ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    above = (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    if not named and not spark.sparkContext.master.startswith("local") and _on_own_disk(spark, above):
        raise ValueError(f"name a folder that all machines share in spark.checkpoint.dir; the warehouse {above} is local")
    root = f"{above}/shelflens-{spark.sparkContext.applicationId}"
    if root not in _made:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _made.add(root)
    return root


def _on_own_disk(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the staging folder."""
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_dropped_when_done(spark: SparkSession) -> Iterator[None]:
    """Once the table is written, the shuffle files behind it are of no more use."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to shared storage and return a scan of what was written."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    with _shuffles_dropped_when_done(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    _paths[id(staged)] = path
    return staged


def unstage(staged: DataFrame) -> None:
    """Delete what `stage` wrote, for tables that are large and soon of no more use."""
    spark = staged.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_paths.pop(id(staged)))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
