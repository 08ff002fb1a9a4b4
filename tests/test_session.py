import pytest

from tidevault import session


class FakeConf:
    def __init__(self, **settings):
        self.settings = settings

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)


class FakeSession:
    def __init__(self, **settings):
        self.conf = FakeConf(**settings)


def test_the_shared_folder_is_the_sessions():
    cluster = FakeSession(spark_checkpoint_dir="hdfs:///ck/", spark_master="yarn")
    assert session.work_dir(cluster, "x").startswith("hdfs:///ck/x-")
    assert session.work_dir(cluster, "x") != session.work_dir(cluster, "x")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(FakeSession(spark_master="yarn"), "x")
    local = session.work_dir(FakeSession(spark_master="local[8]"), "x")
    assert "tidevault-" in local


def test_writers_share_the_timestamp_setting(spark):
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    df = spark.range(1)
    with session.micros_timestamps(df):
        with session.micros_timestamps(df):
            assert spark.conf.get(key) == "TIMESTAMP_MICROS"
        assert spark.conf.get(key) == "TIMESTAMP_MICROS"
    assert spark.conf.get(key) == before
