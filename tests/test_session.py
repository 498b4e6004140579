"""Checkpoint-folder policy of the session helpers (no cluster needed)."""

import pytest

from wrenchcast.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, configured=None):
        self.master = master
        self.dir = None
        self._conf = _Conf({"spark.checkpoint.dir": configured} if configured else {})

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, configured=None):
        self.sparkContext = _Context(master, configured)
        self.conf = _Conf({})


def test_cluster_uses_the_configured_shared_folder():
    s = _Session("spark://cluster:7077", configured="hdfs:///shared/checkpoints")
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/checkpoints"


def test_cluster_without_setting_refuses_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))


def test_local_master_gets_a_temporary_folder():
    path = ensure_checkpoint_dir(_Session("local[4]"))
    assert path and "wrenchcast-ckpt-" in path
