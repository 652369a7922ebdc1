"""Shared scratch and checkpoint folders."""

import pytest

from lumenreg import session as S


class _Context:
    def __init__(self, master, configured=None):
        self.master, self.folder, self.configured = master, None, configured

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path

    def getConf(self):
        return {"spark.checkpoint.dir": self.configured} if self.configured else {}


class _Session:
    def __init__(self, *a):
        self.sparkContext = _Context(*a)


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4]"])
def test_local_master_gets_a_private_folder(master):
    assert "lumenreg-ckpt-" in S.ensure_checkpoint_dir(_Session(master))


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://host:7077", "yarn"])
def test_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Session(master))
    assert S.ensure_checkpoint_dir(_Session(master, "hdfs:///shared")) == "hdfs:///shared"


def test_scratch_is_removed(spark):
    path = S.scratch_dir(spark, "test")
    spark.range(3).write.parquet(path)
    S.remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
