"""Spark session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "shelflens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` in place of dots.

    The number of shuffle partitions is left to the cluster's own setting:
    adaptive execution coalesces small ones and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A category folder named 007 is the text 007.
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
