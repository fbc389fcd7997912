"""Content digests: order-free, sensitive to every value, name and NULL, and additive over parts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from strata.operators import digest as D
from strata.sources import files as io

ROWS = [("o1", "10.00", None), ("o2", "", "x"), ("o2", "", "x"), ("é", "1", "y")]


def one(df, **how):
    return tuple(D.digest(df, **how).first())


def brute(rows, names):
    n = chars = s1 = s2 = x1 = x2 = 0
    for row in rows:
        named = sorted(zip(names, row))
        h = hashlib.md5("".join(f"{k}-" if v is None else f"{k}={len(v)}:{v}" for k, v in named).encode()).hexdigest()
        a, b = int(h[:15], 16), int(h[15:30], 16)
        n, chars, s1, s2, x1, x2 = n + 1, chars + sum(len(v or "") for v in row), s1 + a, s2 + b, x1 ^ a, x2 ^ b
    return (n, chars, s1, s2, x1, x2)


def table(spark, rows, names=("k", "p", "q")):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))


def test_digest_equals_the_formula_and_ignores_order_and_partitions(spark):
    df = table(spark, ROWS)
    assert tuple(map(int, one(df))) == brute(ROWS, ("k", "p", "q"))
    assert one(df.repartition(3).orderBy("q")) == one(df) == one(df.select("q", "k", "p"))
    assert tuple(map(int, one(df.limit(0)))) == (0, 0, 0, 0, 0, 0)


@pytest.mark.parametrize("other", [
    [("o9", "10.00", None), *ROWS[1:]],                       # a value of the same length
    [("o1", "10.00", ""), *ROWS[1:]],                         # the empty text for NULL
    ROWS[:2] + ROWS[3:],                                      # a repeated row gone
    ROWS + [("o2", "", "x")],                                 # and one more
    [("o1", "10.00", None), ("o2", "x", ""), ("o2", "", "x"), ("é", "1", "y")],  # values in each other's column
])
def test_every_change_of_content_changes_the_digest(spark, other):
    assert one(table(spark, other)) != one(table(spark, ROWS))


def test_names_count_as_content(spark):
    df = table(spark, ROWS)
    assert one(df.toDF("k", "q", "p")) != one(df)


def test_digests_of_parts_add_up(spark):
    df = spark.range(500).select((F.col("id") % 7).cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    by_part = D.digest(df, ["k"], columns=["k", "v"])
    assert by_part.count() == 7
    assert tuple(D.merge(by_part).first()) == one(df)
    twice = D.merge(by_part.unionByName(by_part)).first()
    assert twice["rows"] == 1000 and twice["xor1"] == 0


def test_line_manifest_digests_each_file_split_by_split(spark, tmp_path):
    for name, text in (("a.csv", "x\n1\n2\n"), ("b.csv", "x\n2\n1\n"), ("c.csv", "")):
        (tmp_path / "d").mkdir(exist_ok=True)
        (tmp_path / "d" / name).write_text(text)
    read = {r["file_name"]: r for r in io.line_manifest(spark, str(tmp_path)).collect()}
    assert read["a.csv"]["sum1"] == read["b.csv"]["sum1"] and read["a.csv"]["rows"] == 3
    assert set(read) == {"a.csv", "b.csv"} and read["a.csv"]["bytes"] == 6
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        (tmp_path / "d" / "long.csv").write_text("\n".join(f"line {k}" for k in range(2000)))
        lines = io.line_manifest(spark, str(tmp_path))
        whole = next(r for r in lines.collect() if r["file_name"] == "long.csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole["rows"] == 2000
    assert whole["sum1"] == sum(int(hashlib.md5(f"line {k}".encode()).hexdigest()[:15], 16) for k in range(2000))
    assert "content" not in lines._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
