"""Where intermediate tables go."""

import os

import pytest

from regiobank.sources.scratch import scratch_path, scratch_root, scratch_scope, stage


class Context:
    def __init__(self, master, configured=None):
        self.master, self.configured, self.folder = master, configured, None

    def getConf(self):
        return {"spark.checkpoint.dir": self.configured} if self.configured else {}

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, *args):
        self.sparkContext = Context(*args)


def test_folder_comes_from_the_session():
    assert scratch_root(Session("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("spark://host:7077"))


def test_a_local_cluster_is_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session("local-cluster[2,1,1024]"))


def test_scope_removes_what_was_staged(spark):
    with scratch_scope(spark):
        staged = stage(spark.range(3).toDF("id"), "scoped")
        [path] = {name.rsplit("/", 1)[0] for name in staged.inputFiles()}
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:"))


def test_local_fallback_is_kept():
    session = Session("local[2]")
    assert scratch_root(session) == scratch_root(session)


def test_staged_table_equals_its_source(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS name")
    staged = stage(df, "test")
    assert staged.schema.simpleString() == df.schema.simpleString() and staged.exceptAll(df).count() == 0
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
