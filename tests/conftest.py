from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelflens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(folder / "checkpoint"),
        spark__sql__warehouse__dir=str(folder / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def value_of(spark):
    """Value of a column expression over one text."""
    from pyspark.sql import functions as F

    def evaluate(function, text, *args):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(function(F.col("t"), *args).alias("v")).first().v

    return evaluate
