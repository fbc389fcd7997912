"""Folders, written intermediate tables and small conventions the operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Orders a null doc_id behind every other one.
NULL_ID = 2**63 - 1


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; set here only where it is unset (local tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder below the shared one."""
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that the operators wrote in this application; call when their results have been read or written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, whatever executors go."""
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordered_id(name: str = "doc_id") -> Column:
    """doc_id as a long that sorts nulls last, usable as a join key."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def plain_id(name: str) -> Column:
    """``ordered_id`` as given: null again where it was null."""
    return F.when(F.col(name) < NULL_ID, F.col(name))


def distinct_ids(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own."""
    n, known = docs.agg(F.count(F.lit(1)), F.count_distinct(F.col("doc_id").cast("long"))).first()
    return n == known


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__id``, a long of each row's own, in the order of doc_id (null last).

    Where every row has a doc_id of its own, that is it. Otherwise rows are sorted once by doc_id, text hash
    and place, numbered and written, so that every use sees the same numbers; rows that
    share a doc_id, or have none, are documents of their own. The sort's further keys
    deal a doc_id that many rows share over many tasks.
    """
    given = F.col("doc_id").cast("long")
    if distinct_ids(docs):
        return docs.withColumn("__id", given)
    ordered = (docs.withColumn("__id", F.monotonically_increasing_id())
               .orderBy(given.asc_nulls_last(), F.xxhash64("text"), "__id"))
    return stored(ordered.withColumn("__id", F.monotonically_increasing_id()), "identified")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
