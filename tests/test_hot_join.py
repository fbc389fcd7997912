"""A key with half of the rows is dealt over tasks; distinct counts of several columns take one scan."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.operators.skew import hot_keys, spread_join

SETTINGS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}


@pytest.fixture
def plain(spark):
    """Sort-merge joins without adaptive execution."""
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_half_of_the_rows_under_one_key(plain):
    many = plain.range(4000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 101 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 397)).alias("key"), "id")
    one = plain.createDataFrame([("hot", 1), ("hot", 2), *[(f"k{k}", k) for k in range(300)], (None, 5)], "key string, n int")
    got = spread_join(one, many, "key")
    assert got.columns == one.join(many, "key").columns
    rows = lambda df: Counter(map(tuple, df.collect()))
    assert rows(got) == rows(one.join(many, "key"))
    share = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] / got.count()
    alone = one.join(many, "key")
    before = alone.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] / alone.count()
    assert before > 0.6 and share < 0.4
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def test_hot_keys_are_those_over_a_share(plain):
    df = plain.range(1000).select(F.when(F.col("id") < 400, "a").when(F.col("id") < 550, "b").otherwise(
        F.col("id").cast("string")).alias("key"))
    assert dict(hot_keys(df, "key", 8)) == {"a": 4, "b": 2}
    assert hot_keys(df.filter("key > 'c'"), "key", 8) == hot_keys(df.limit(0), "key", 8) == []


def test_keys_of_several_columns_in_one_scan(spark):
    data = [("a", "x", None), ("a", "y", None), ("b", None, None), (None, "x", None)]
    df = spark.createDataFrame(data, "p string, q string, r string")
    got = P.keys(df, "t", ["p", "q", "r"])
    assert {r["column_name"]: (r["rows"], r["distinct_values"], r["is_key"]) for r in got.collect()} == {
        "p": (4, 2, False), "q": (4, 2, False), "r": (4, 0, False)}
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Expand" not in plan and plan.count("LocalTableScan") + plan.count("Scan ExistingRDD") == 1
    empty = P.keys(df.limit(0), "t", ["p", "q"]).collect()
    assert sorted((r["column_name"], r["rows"], r["is_key"]) for r in empty) == [("p", 0, True), ("q", 0, True)]
    mixed = spark.createDataFrame([(1, "1"), (2, "1"), (2, None)], "n long, s string")
    assert {r["column_name"]: r["distinct_values"] for r in P.keys(mixed, "t", ["n", "s"]).collect()} == {"n": 2, "s": 1}
