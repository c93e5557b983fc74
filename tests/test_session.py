"""Checkpoint-folder policy, workspaces and the tables of a run."""

import pytest

from corvid.session import Tables, checkpoint_dir, path_exists, scratch_path, workspace


class FakeConf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class FakeContext:
    def __init__(self, master, current=None, conf=None):
        self.master = master
        self._dir = current
        self._conf = FakeConf(conf or {})

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class FakeSession:
    def __init__(self, sc, conf=None):
        self._sc = sc
        self.conf = FakeConf(conf or {})

    @property
    def sparkContext(self):
        if self._sc is None:
            raise RuntimeError("no context in this process")
        return self._sc


def test_existing_folder_wins():
    s = FakeSession(FakeContext("yarn", current="hdfs:///ckpt/a"),
                    {"spark.checkpoint.dir": "hdfs:///ckpt/b"})
    assert checkpoint_dir(s) == "hdfs:///ckpt/a"


def test_setting_is_used_when_no_folder_is_set():
    sc = FakeContext("yarn")
    s = FakeSession(sc, {"spark.checkpoint.dir": "hdfs:///ckpt/b"})
    assert checkpoint_dir(s) == "hdfs:///ckpt/b"
    assert sc.getCheckpointDir() == "hdfs:///ckpt/b"


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(FakeSession(FakeContext("yarn")))


def test_local_session_gets_a_temporary_folder():
    sc = FakeContext("local[4]")
    d = checkpoint_dir(FakeSession(sc))
    assert d and "corvid-ckpt-" in d


def test_session_without_context_uses_the_setting():
    assert checkpoint_dir(FakeSession(None, {"spark.checkpoint.dir": "s3a://b/c"})) == "s3a://b/c"
    with pytest.raises(RuntimeError):
        checkpoint_dir(FakeSession(None))


def test_tables_are_read_in_place_and_settings_stay(spark, tmp_path):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled",
                                             "spark.sql.shuffle.partitions")}
    t = Tables(spark, str(tmp_path / "run"), 3)
    rows = spark.range(100).selectExpr("id", "id % 7 as v")
    assert not t.finished("a")
    for name in ("a", "b"):
        t.write(name, rows.repartition(3, "id"), "id")
    assert t.finished("a")
    a, b = (t.read(n, "id", "id long, v long") for n in "ab")
    plan = a.hint("merge").join(b, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort [" not in plan, plan
    assert a.rdd.getNumPartitions() == 3
    assert {k: spark.conf.get(k) for k in before} == before
    # the folder alone is enough: names are registered again
    t.forget("a")
    again = Tables(spark, str(tmp_path / "run"), 3)
    assert again.read("a", "id", "id long, v long").count() == 100
    assert again.files("a", "id long, v long").agg({"v": "sum"}).first()[0] == sum(i % 7 for i in range(100))
    again.drop("a", "b")
    assert not path_exists(spark, t.path("a"))


def test_workspace_owns_its_folder(spark):
    assert scratch_path(spark, "x").startswith(checkpoint_dir(spark))
    with workspace(spark) as folder:
        path = scratch_path(spark, "x")
        assert path.startswith(folder)
        spark.range(3).write.parquet(path)
        assert path_exists(spark, path)
    assert not path_exists(spark, folder) and not scratch_path(spark, "x").startswith(folder)
