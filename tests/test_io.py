import glob
import os

import pyarrow.parquet as pq
import pytest

from strata.operators import silver as S
from strata.sources import files as io
from strata.sources.schemas import ORDER_ITEMS_COLUMNS


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_binds_columns_by_name(spark, tmp_uri):
    # header order differs from the contract: values must follow their names
    _write(f"{tmp_uri}/items/a.csv",
           "price,order_id,order_item_id,product_id,seller_id,shipping_limit_date,freight_value\n"
           "58.90,o1,1,p1,s1,2017-09-19 09:45:35,13.29\n"
           ",o2,2,p2,s2,,\n")
    read = io.read_csv_by_name(spark, f"{tmp_uri}/items", ORDER_ITEMS_COLUMNS)
    assert read.missing == []
    rows = {r["order_id"]: r for r in S.order_items(read.frame).collect()}
    assert str(rows["o1"]["price"]) == "58.90" and rows["o1"]["order_item_id"] == 1
    assert rows["o2"]["price"] is None and rows["o2"]["shipping_limit_date"] is None  # empty -> NULL


def test_csv_missing_column_reported(spark, tmp_uri):
    _write(f"{tmp_uri}/x/a.csv", "order_id,price\no1,1.00\n")
    read = io.read_csv_by_name(spark, f"{tmp_uri}/x", ORDER_ITEMS_COLUMNS)
    assert "product_id" in read.missing and read.frame.columns == list(ORDER_ITEMS_COLUMNS)
    assert read.frame.collect()[0]["product_id"] is None


def test_publish_round_trip(spark, tmp_uri):
    df = spark.range(1000).selectExpr("cast(id as string) as k", "id % 7 as v")
    io.publish(df, f"{tmp_uri}/t")
    io.publish(df.limit(10), f"{tmp_uri}/t")  # overwrite
    assert io.read_table(spark, f"{tmp_uri}/t").count() == 10


def test_sorted_export_is_globally_ordered(spark, tmp_uri):
    df = spark.range(5000).selectExpr("(id * 7919) % 997 as a", "cast(id % 13 as string) as b", "id")
    paths = io.export_sorted(df.repartition(8), f"{tmp_uri}/out/model", ["a", "b"])
    files = sorted(glob.glob(paths["parquet"] + "/part-*.parquet"))
    keys = [k for f in files for k in zip(*[pq.read_table(f).column(c).to_pylist() for c in ("a", "b")])]
    assert len(keys) == 5000 and keys == sorted(keys)
    csv = spark.read.option("header", True).csv(paths["csv"])
    assert csv.count() == 5000 and csv.columns == ["a", "b", "id"]


def test_mixed_headers_fail_or_follow_their_names(spark, tmp_uri):
    _write(f"{tmp_uri}/x/a.csv", "order_id,price\no1,10.00\n")
    _write(f"{tmp_uri}/x/b.csv", "price,order_id\n20.00,o2\n")
    _write(f"{tmp_uri}/x/c.csv", "order_id,price,colour\no3,30.00,red\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv_by_name(spark, f"{tmp_uri}/x", ("order_id", "price")).frame.collect()
    read = io.read_csv_variants(spark, f"{tmp_uri}/x", ("order_id", "price"))
    assert sorted(map(tuple, read.frame.collect())) == [("o1", "10.00"), ("o2", "20.00"), ("o3", "30.00")]
    assert read.missing == [] and read.header == ["order_id", "price", "colour"]


def test_failed_publish_leaves_the_old_table(spark, tmp_uri):
    dest = f"{tmp_uri}/t"
    io.publish(spark.range(5), dest)
    with pytest.raises(Exception):
        io.publish(spark.range(5).selectExpr("assert_true(id < 3) as a", "id"), dest)
    assert io.read_table(spark, dest).count() == 5


def test_switch_undoes_a_failed_move(spark, tmp_uri):
    dest = f"{tmp_uri}/t"
    io.publish(spark.range(5), dest)
    with pytest.raises(Exception):
        io.switch(spark, f"{tmp_uri}/never-written", dest)
    assert io.read_table(spark, dest).count() == 5


def test_manifest_and_compare(spark, tmp_uri):
    _write(f"{tmp_uri}/src/orders/a.csv", "x\n1\n")
    _write(f"{tmp_uri}/src/items/b.csv", "y\n2\n")
    _write(f"{tmp_uri}/dst/orders/a.csv", "x\n1\n")
    _write(f"{tmp_uri}/dst/items/c.csv", "z\n")
    src, dst = (io.manifest(spark, f"{tmp_uri}/{d}", "*.csv") for d in ("src", "dst"))
    status = {(r["dataset"], r["file_name"]): r["status"] for r in io.compare_manifests(src, dst).collect()}
    assert status == {("orders", "a.csv"): "same", ("items", "b.csv"): "missing",
                      ("items", "c.csv"): "unexpected"}
    totals = {r["dataset"]: (r["files"], r["bytes"]) for r in io.dataset_totals(src).collect()}
    assert totals == {"orders": (1, 4), "items": (1, 4)}
    read = {n: io.content_manifest(spark, {"orders": f"{tmp_uri}/{n}/orders"}) for n in ("src", "dst")}
    assert [tuple(r)[:3] for r in read["src"].collect()] == [("orders", 1, 1)]
    _write(f"{tmp_uri}/dst/orders/a.csv", "x\n123\n")
    changed = io.compare_manifests(read["src"], io.content_manifest(spark, {"orders": f"{tmp_uri}/dst/orders"}),
                                   keys=("dataset",)).collect()
    assert [r["status"] for r in changed] == ["changed"]


def test_manifest_does_not_read_content(spark, tmp_uri):
    _write(f"{tmp_uri}/m/d/a.csv", "x\n")
    plan = io.manifest(spark, f"{tmp_uri}/m")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_publish_partitioned_round_trip(spark, tmp_uri):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as string) as part")
    io.publish(df, f"{tmp_uri}/p", partition_by=["part"])
    back = io.read_table(spark, f"{tmp_uri}/p")
    assert back.count() == 100 and sorted(str(r["part"]) for r in back.select("part").distinct().collect()) == ["0", "1", "2"]
    assert glob.glob(f"{tmp_uri}/p/*/part=0") and back.schema["part"].dataType.simpleString() == "string"


def test_export_rejects_unknown_format(spark, tmp_uri):
    with pytest.raises(ValueError):
        io.export_sorted(spark.range(3), f"{tmp_uri}/x", ["id"], formats=("xlsx",))


def test_one_sort_serves_both_formats(spark, tmp_uri):
    df = spark.range(20_000).selectExpr("(id * 7919) % 9973 as a", "cast(id % 13 as string) as b", "id").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several part files from few rows
    try:
        once = io.sorted_once(df, ["a", "b"])
        for plan in (once, once.select("a")):
            assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
        assert once.rdd.getNumPartitions() > 1
        paths = io.export_sorted(df, f"{tmp_uri}/out/model", ["a", "b"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(paths["csv"] + "/part-*.csv")) > 1
    rows = []
    for f in sorted(glob.glob(paths["csv"] + "/part-*.csv")):
        with open(f) as lines:
            rows += [tuple(x.strip().split(",")) for x in list(lines)[1:]]
    assert len(rows) == 20_000 and [(int(a), b) for a, b, _ in rows] == sorted((int(a), b) for a, b, _ in rows)
    files = sorted(glob.glob(paths["parquet"] + "/part-*.parquet"))
    assert [k for f in files for k in pq.read_table(f).column("id").to_pylist()] == [int(i) for _, _, i in rows]
