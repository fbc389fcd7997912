"""Statistics kept with published parts: equal to a scan, read instead of rows, carried over by unchanged parts."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.operators import reconcile as R
from strata.operators import statistics as ST
from strata.plans import jobs as J
from strata.sources import files as io
from tests.fixtures import item, items, order, orders

ITEMS = [item("o1", "1", "p1"), item("o1", "2", "p1"), item("o2", "1", "p2", price="49.90"), item("o3", "1", "p1"),
         item("o4", "1", "p3", price="5.00")]
ORDERS = [order("o1", "delivered", "2018-01-15 08:00:00"), order("o2", "delivered", "2018-02-20 09:30:00"),
          order("o3", "delivered", "2018-02-21 09:30:00"), order("o4", "shipped", "2018-03-01 10:00:00")]


def extracts(spark, root, item_rows=ITEMS, order_rows=ORDERS):
    items(spark, item_rows).write.mode("overwrite").option("header", True).csv(f"{root}/items")
    orders(spark, order_rows).write.mode("overwrite").option("header", True).csv(f"{root}/orders")
    return f"{root}/orders", f"{root}/items"


@pytest.fixture
def built(spark, tmp_uri):
    o, i = extracts(spark, tmp_uri)
    for out in (J.run_silver(spark, o, i, f"{tmp_uri}/silver"),
                J.build_gold(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold", None, ["delivered"])):
        assert out.status == "OK", out.error
    return o, i


def values(spark, root, built, statuses, kept):
    frames = J.layer_frames(spark, *built, f"{root}/silver", f"{root}/gold")
    return R.LayerMetrics(frames, statuses, kept).frame().collect()[0].asDict()


@pytest.mark.parametrize("statuses", [["delivered"], ["delivered", "shipped"], ["shipped"], []])
def test_kept_statistics_equal_a_scan(spark, tmp_uri, built, statuses):
    kept = J.kept_statistics(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold")
    assert set(kept) == {"silver.orders", "silver.items", "silver.sales", "gold.daily"}
    assert values(spark, tmp_uri, built, statuses, kept) == values(spark, tmp_uri, built, statuses, {})


def test_validation_reads_no_published_rows(spark, tmp_uri, built):
    first = J.validate_layers(spark, *built, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"])
    scanned = J.validate_layers(spark, *built, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"], scan=True)
    told = lambda out: [(r["check"], r["result"], r["message"]) for r in out.results]
    assert first.status == scanned.status == "OK" and told(first) == told(scanned)
    for f in glob.glob(f"{tmp_uri}/silver/**/*.parquet", recursive=True) + glob.glob(f"{tmp_uri}/gold/**/*.parquet", recursive=True):
        with open(f, "wb") as spoiled:
            spoiled.write(b"not a table any more")
    again = J.validate_layers(spark, *built, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"])
    assert told(again) == told(first)
    out = J.validate_layers(spark, *built, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"], scan=True)
    assert out.status == "ERROR"


def test_kept_months_keep_their_statistics(spark, tmp_uri, built, monkeypatch):
    o, i = extracts(spark, tmp_uri, [*ITEMS[:-2], item("o3", "1", "p9", price="120.00"), ITEMS[-1]])
    assert J.run_silver(spark, o, i, f"{tmp_uri}/silver").status == "OK"
    seen, measure = [], ST.measure_parts

    def noted(df, shape, part=None):
        found = measure(df, shape, part)
        seen.append(sorted(found))
        return found

    monkeypatch.setattr(ST, "measure_parts", noted)
    assert J.build_gold(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold", None, ["delivered"]).status == "OK"
    assert seen == [["2018-02"]]
    kept = J.kept_statistics(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold")
    assert values(spark, tmp_uri, (o, i), ["delivered"], kept) == values(spark, tmp_uri, (o, i), ["delivered"], {})


def test_tables_without_statistics_are_measured(spark, tmp_uri, built):
    dest = f"{tmp_uri}/silver/order_product_sales"
    io.publish(io.read_table(spark, dest).limit(2), dest)
    kept = J.kept_statistics(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold")
    assert "silver.sales" not in kept
    out = J.validate_layers(spark, *built, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"])
    assert out.status == "FAILED"


def test_parts_add_up(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1, "x", 2), ("a", 1, "y", 3), ("b", 2, None, 5), ("b", 2, "x", None), (None, 2, "x", 7)],
                               "part string, day int, status string, n long")
    shape = ST.Shape(("n",), "status", (("day", "status"), ("status",)), "day")
    parts = ST.measure_parts(df, shape, F.coalesce("part", F.lit("none")))
    s = ST.Statistics(shape, parts.values(), ST.measure_whole(df, shape))
    assert (s.rows(), s.rows(["x"]), s.rows([]), s.total("n"), s.total("n", ["x", "y"])) == (5, 3, 0, 17, 12)
    assert s.distinct(("status",)) == 3 and s.distinct(("n",)) is None and s.total("day") is None
    assert ST.Statistics(shape, parts.values()).distinct(("status",)) is None
    facts = ST.facts(shape, parts)
    assert ST.Statistics.of(shape, facts, ["a", "c"]) is None
    assert ST.Statistics.of(ST.Shape(("day",)), facts, ["a"]) is None and ST.Statistics.of(shape, {}, ["a"]) is None
    monkeypatch.setattr(ST, "VALUES", 2)
    assert ST.measure_parts(df, shape) is None
    assert ST.measure_parts(df.limit(0), shape) == {}
