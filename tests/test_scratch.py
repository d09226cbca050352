from types import SimpleNamespace

import pytest

from tabwright.functions.scratch import materialise, shared_dir


class Context:
    def __init__(self, master):
        self.folder, self.master = None, master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(configured, master="local[2]"):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured),
                           sparkContext=Context(master))


def test_configured_folder_is_used():
    assert shared_dir(session("hdfs://shared/ckpt/")) == "hdfs://shared/ckpt"


def test_own_folder_only_where_unset():
    spark = session(None)
    first = shared_dir(spark)
    assert spark.sparkContext.folder == first and shared_dir(spark) == first


def test_no_folder_of_one_machine_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "spark://host:7077"))
    assert shared_dir(session("s3a://shared", "yarn")) == "s3a://shared"


def test_materialised_table_has_no_lineage(spark):
    df = materialise(spark.range(10).repartition(3), "t")
    plan = df._jdf.queryExecution().toString()
    assert df.count() == 10 and "Exchange" not in plan
