import pytest

from viewtally.session import ensure_checkpoint_dir


def test_checkpoint_folder_stays(spark):
    first = ensure_checkpoint_dir(spark)
    assert {ensure_checkpoint_dir(spark) for _ in range(500)} == {first}
    assert spark.range(3).checkpoint().count() == 3


class Cluster:
    """A session on a cluster master without a checkpoint folder."""
    master = "yarn"

    def __init__(self, folder=None):
        self.sparkContext, self.conf, self.folder, self.now = self, self, folder, None

    def getCheckpointDir(self):
        return self.now

    def setCheckpointDir(self, d):
        self.now = f"{d}/uuid"

    def get(self, key, default):
        return self.folder or default


def test_a_cluster_names_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())
    s = Cluster("hdfs:///ck")
    assert ensure_checkpoint_dir(s) == ensure_checkpoint_dir(s) == "hdfs:///ck/uuid"
