"""Layers that several checks read are built once, and what a check has counted is not grouped again."""

import pytest

from strata.operators import statistics as ST
from strata.plans import catalog, jobs as J
from strata.sources import files as io
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_gold_tests_read_written_layers(spark):
    for name in ("gold_tests", "gold_tests_twice", "gold_tests_dirty"):
        assert "Join" not in plan(catalog.QUERIES[name](spark, SF_SMALL))
    lay = catalog.layers(spark, SF_SMALL, "dirty", "dirty")
    kept = catalog.held(lay)
    for name in ("sales", "gold"):
        made, written = getattr(lay, name), getattr(kept, name)
        assert written.schema.simpleString() == made.schema.simpleString()
        assert written.exceptAll(made).isEmpty() and made.exceptAll(written).isEmpty()


def test_gold_is_built_from_published_sales(spark, tmp_uri, monkeypatch):
    plans, publish = {}, io.publish
    monkeypatch.setattr(catalog.io, "publish", lambda df, at: plans.update({at.rsplit("/", 1)[1]: plan(df)}) or publish(df, at))
    catalog.published(catalog.layers(spark, SF_SMALL), tmp_uri)
    assert "Join" in plans["order_product_sales"] and "Join" not in plans["daily_product_sales"]


def test_keys_counted_by_a_check_are_not_grouped_again(spark):
    rows = [("a", "x", 1, "F"), ("a", "x", 2, "O"), ("b", "x", 3, "F"), (None, "x", 4, None), (None, "x", 5, "F"), ("b", None, 6, "F")]
    df = spark.createDataFrame(rows, "order_id string, product_id string, quantity int, order_status string").withColumn(
        "item_revenue", catalog.F.col("quantity").cast("decimal(10,2)"))
    found = [{"check": "unique_order_id_product_id", "table_name": J.SALES_TABLE, "affected_rows": 2},
             {"check": "unique_order_id_product_id", "table_name": "other", "affected_rows": 5}]
    assert J.counted_surplus(found, J.SALES_TABLE, J.SHAPES[J.SALES_TABLE]) == {("order_id", "product_id"): 2}
    part = lambda facts: facts["statistics"]["parts"][""]
    by = lambda facts: (sorted(map(str, part(facts)["groups"])), part(facts)["distinct"])
    assert by(J.kept_facts(J.SALES_TABLE, df, found)) == by(J.kept_facts(J.SALES_TABLE, df))
    assert J.kept_facts(J.SALES_TABLE, df)["statistics"]["parts"][""]["distinct"] == {"order_id,product_id": 4}
    # A surplus of several parts belongs to none of them.
    shape = ST.Shape(keys=(("order_id", "product_id"),))
    parts = ST.measure_parts(df, shape, catalog.F.coalesce("order_status", catalog.F.lit("-")))
    assert {p: x["distinct"]["order_id,product_id"] for p, x in parts.items()} == {"F": 4, "O": 1, "-": 1}
    with pytest.raises(ValueError):
        ST.add_counted(parts, {("order_id", "product_id"): 2})
