"""Shared-folder resolution (no Spark needed: a stub session)."""

import pytest

from visitlens.session import shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = "file:" + path + "/run-1"


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_configured_folder_wins():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"


def test_context_folder_is_used():
    assert shared_dir(_Session("yarn", checkpoint="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_cluster_without_folder_fails():
    with pytest.raises(RuntimeError):
        shared_dir(_Session("yarn"))


def test_local_session_gets_a_stable_private_folder():
    s = _Session("local[2]")
    first = shared_dir(s)
    assert first.startswith("file:/") and shared_dir(s) == first
