"""Session helpers: the shared folder is read from the session, never invented."""

import pytest

from tessera import session


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def __init__(self, ckpt=None, parallelism=8):
        self.ckpt, self.defaultParallelism = ckpt, parallelism

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, d):
        self.ckpt = d


class _Session:
    def __init__(self, conf=None, ckpt=None):
        self.conf, self.sparkContext = _Conf(conf or {}), _Ctx(ckpt)


def test_no_shared_folder_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session())


def test_shared_folder_from_conf_or_context():
    assert session.shared_dir(_Session({"spark.checkpoint.dir": "hdfs://nn/ckpt/"})) == "hdfs://nn/ckpt"
    assert session.shared_dir(_Session(ckpt="s3a://b/ckpt")) == "s3a://b/ckpt"


def test_fresh_paths_differ():
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert session.fresh_path(s, "x") != session.fresh_path(s, "x")


def test_only_one_machine_sessions_get_a_scratch_folder():
    s = _Session()
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_shared_dir(s)
    s.sparkContext.master = "local[8]"
    session.ensure_shared_dir(s)
    assert s.sparkContext.ckpt


def test_use_shared_checkpoint_dir_only_from_session():
    s = _Session()
    assert session.use_shared_checkpoint_dir(s) is False and s.sparkContext.ckpt is None
    s = _Session({"spark.checkpoint.dir": "hdfs://nn/ckpt"})
    assert session.use_shared_checkpoint_dir(s) is True and s.sparkContext.ckpt == "hdfs://nn/ckpt"


def test_shuffle_partitions_fallback():
    assert session.shuffle_partitions(_Session({"spark.sql.shuffle.partitions": "64"})) == 64
    assert session.shuffle_partitions(_Session({"spark.sql.shuffle.partitions": "auto"})) == 200
