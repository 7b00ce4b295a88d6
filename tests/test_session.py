import os
from types import SimpleNamespace

import pytest

from freshet.session import scratch_dir, shared_dir
from freshet.sinks.target import staged


def session(master, folder=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: folder), sparkContext=context)


def test_the_cluster_names_the_shared_folder():
    assert shared_dir(session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("yarn", None, "hdfs:///checkpoints")) == "hdfs:///checkpoints"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn"))
    first, second = (scratch_dir(session("yarn", "hdfs:///shared/"), "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_staged_files_go_away(spark):
    folder = shared_dir(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with staged(spark.range(10).selectExpr("id", "id as `a.b`")) as df:
        assert df.selectExpr("sum(`a.b`)").first()[0] == 45
    (made,) = set(os.listdir(folder)) - before
    assert not [f for _, _, files in os.walk(os.path.join(folder, made)) for f in files if f.endswith(".parquet")]
