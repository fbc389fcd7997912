import pytest

from strata.session import build_session, drop_scratch, hadoop_path, scratch_path, shared_dir


def test_shared_dir_is_below_the_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark).startswith(base.rstrip("/"))
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark, "x"))


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_an_existing_session_is_left_as_it_is(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Lima")
    try:
        assert build_session("other").conf.get("spark.sql.session.timeZone") == "America/Lima"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_can_be_dropped(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    drop_scratch(spark)
    fs, p = hadoop_path(spark, path)
    assert not fs.exists(p)
