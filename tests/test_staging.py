"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from shelflens import staging


def elsewhere(spark, **named):
    """The session as it would look on a cluster, with these settings."""
    context = spark.sparkContext
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: named.get(key, default)),
        sparkContext=SimpleNamespace(
            master="yarn", applicationId=context.applicationId, getCheckpointDir=lambda: None,
            _jvm=context._jvm, _jsc=context._jsc,
        ),
    )


def test_a_local_warehouse_is_refused_on_a_cluster(spark, tmp_path):
    for folder in (str(tmp_path), f"file:{tmp_path}"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            staging.stage_root(elsewhere(spark, **{"spark.sql.warehouse.dir": folder}))


def test_a_named_folder_is_taken(spark, tmp_path):
    root = staging.stage_root(elsewhere(spark, **{"spark.checkpoint.dir": f"{tmp_path}/", "spark.sql.warehouse.dir": "/nowhere"}))
    assert root == f"{tmp_path}/shelflens-{spark.sparkContext.applicationId}"


def test_staged_tables_go_when_freed(spark):
    table = staging.stage(spark.range(5), "few")
    path = staging._paths[id(table)]
    assert table.count() == 5
    staging.unstage(table)
    gone = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    assert not gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(gone)
