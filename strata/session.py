"""Session helpers.

Jobs receive a session from whoever runs them (spark-submit, a notebook, the test
fixture). ``build_session`` is a convenience for local runs, tests and the command line;
a setting that the cluster or an existing session already has is left as it is.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings the pipeline relies on, applied only where nothing is set. Time zone: typed
# timestamps come from zone-less text.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "strata", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """The active session unchanged, or a new one; ``extra`` is the caller's own choice and wins over defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    given = SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not given.contains(k)}
    if shuffle_partitions and not given.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where it is unset, a local-mode session gets a folder of its own; a cluster must set it."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strata-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """This application's folder below the checkpoint dir, reachable from every executor."""
    return "/".join([checkpoint_dir(spark), "strata", spark.sparkContext.applicationId, *parts])


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique location under the application's folder (one per call)."""
    return shared_dir(spark, kind, uuid.uuid4().hex)


def hadoop_path(spark: SparkSession, uri: str):
    """The file system of a URI and its path there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def drop_scratch(spark: SparkSession) -> None:
    """Remove everything this application wrote as scratch; call when its results have been read."""
    fs, path = hadoop_path(spark, shared_dir(spark))
    fs.delete(path, True)
