import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import profile as P
from strata.operators import silver as S
from strata.operators.quantiles import exact_percentiles
from tests.fixtures import item, items, order, orders

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
       st.integers(min_value=1, max_value=7))
def test_exact_percentiles_match_numpy(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x int")
    got = {r["p"]: r["value"] for r in exact_percentiles(df, "x", PROBS, slices=parts).collect()}
    want = np.quantile(np.array(values, dtype=float), PROBS)  # linear interpolation
    for p, w in zip(PROBS, want):
        assert abs(got[p] - w) < 1e-9, (p, got[p], w)


def test_percentiles_with_a_hot_value(spark):
    vals = [7] * 500 + list(range(100))
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = {r["p"]: r["value"] for r in exact_percentiles(df, "x", PROBS, 4).collect()}
    for p, w in zip(PROBS, np.quantile(np.array(vals, dtype=float), PROBS)):
        assert abs(got[p] - w) < 1e-9


def _frames(spark):
    bi = items(spark, [item("o1", "1", "p1", "s1", price="100.00"), item("o1", "2", "p1", "s2", price="100.00"), item("o1", "3", "p2", "s1", price="10.00"),
                       item("o2", "1", "p1", "s1", price="90.00"), item("o9", "1", "p3", "s3", price="5.00"),
                       item(None, "1", "p4", "s4", price="1.00")])
    bo = orders(spark, [order("o1"), order("o2", "shipped"), order("o3", "canceled"), order("o4", "canceled"),
                        order(None, "canceled")])
    return S.orders(bo), S.order_items(bi)


def _pandas(df):
    return df.toPandas()


def test_join_coverage_matches_pandas_merge(spark):
    so, si = _frames(spark)
    o, i = _pandas(so)[["order_id"]], _pandas(si)[["order_id"]]
    want = o.merge(i, on="order_id", how="outer", indicator=True)["_merge"].value_counts()
    got = {r["side"]: r["rows"] for r in P.join_coverage(so, si).collect()}
    assert got == {"both": int(want["both"]), "left_only": int(want["left_only"]),
                   "right_only": int(want["right_only"])}


def test_key_set_difference_and_orders_without_items(spark):
    so, si = _frames(spark)
    got = {r["direction"]: r["keys"] for r in P.key_set_difference(so, si).collect()}
    assert got == {"items_not_in_orders": 1, "orders_not_in_items": 2}
    by_status = {r["order_status"]: r["orders"] for r in P.orders_without_items_by_status(so, si).collect()}
    assert by_status == {"canceled": 3}


def test_order_summary_and_top(spark):
    so, si = _frames(spark)
    rows = {r["order_id"]: r for r in P.order_summary(so, si).collect()}
    assert set(rows) == {"o1", "o2"}
    assert (rows["o1"]["items"], rows["o1"]["distinct_products"], rows["o1"]["distinct_sellers"]) == (3, 2, 2)
    assert str(rows["o1"]["total_price"]) == "210.00"
    assert [r["order_id"] for r in P.top_orders_by_items(so, si, 1).collect()] == ["o1"]


def test_repeated_products_and_price_consistency(spark):
    _, si = _frames(spark)
    r = P.repeated_products(si).collect()
    assert [(x["quantity"], x["pairs"], x["total_pairs"], x["repeated_pairs"]) for x in r] == [(2, 1, 4, 1)]
    assert r[0]["repeated_pct"] == 25.0
    pc = P.price_consistency(si).collect()
    assert len(pc) == 1 and pc[0]["distinct_prices"] == 1
    s = P.price_consistency_summary(si).collect()[0]
    assert (s["repeated_pairs"], s["single_price_pairs"]) == (1, 1)


def test_nulls_duplicates_keys(spark):
    so, si = _frames(spark)
    n = {(r["table_name"], r["column_name"]): (r["nulls"], r["pct"]) for r in P.nulls(si, "order_items").collect()}
    assert n[("order_items", "order_id")] == (1, round(100 / 6, 2))
    d = {r["duplicate_kind"]: r["duplicate_rows"] for r in P.duplicates(so, "orders", ["order_id"]).collect()}
    assert d == {"full_row": 0, "(order_id)": 0}
    k = {r["column_name"]: (r["rows"], r["distinct_values"], r["is_key"])
         for r in P.keys(so, "orders", ["order_id", "order_status"]).collect()}
    assert k["order_id"] == (5, 4, False) and k["order_status"] == (5, 3, False)


def test_value_distribution_and_text_summary(spark):
    so, _ = _frames(spark)
    vd = {r["order_status"]: (r["rows"], r["pct"]) for r in P.value_distribution(so, "order_status").collect()}
    assert vd == {"delivered": (1, 20.0), "shipped": (1, 20.0), "canceled": (3, 60.0)}
    ts = P.text_summary(so, ["order_status"]).collect()[0]
    assert (ts["count"], ts["distinct_values"], ts["top"], ts["freq"]) == (5, 3, "canceled", 3)


def test_numeric_summary_matches_pandas_describe(spark):
    _, si = _frames(spark)
    got = P.numeric_summary(si, ["price"]).collect()[0]
    d = _pandas(si)["price"].astype(float).describe()
    for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                         ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
        assert abs(float(got[ours]) - round(float(d[theirs]), 4)) < 1e-9, ours


def test_items_per_order_and_anomalies(spark):
    _, si = _frames(spark)
    hist = {r["items"]: r["orders"] for r in P.items_per_order(si).collect()}
    assert hist == {3: 1, 1: 2}
    a = P.anomalies(si).collect()[0]
    assert a["null_order_id"] == 1 and a["price_not_positive"] == 0


def test_top_priced_items_tie_break(spark):
    _, si = _frames(spark)
    top = P.top_priced_items(si, 2).collect()
    assert [(r["order_id"], r["order_item_id"]) for r in top] == [("o1", 1), ("o1", 2)]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-20, 20)),
                          st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False))),
                min_size=1, max_size=200))
def test_column_percentiles_several_columns_match_numpy(spark, rows):
    from strata.operators.quantiles import column_percentiles
    df = spark.createDataFrame(rows, "a int, b double")
    got = {(r["column_name"], r["p"]): r["value"]
           for r in column_percentiles(df, ["a", "b"], PROBS, slices=3).collect()}
    for i, c in enumerate(("a", "b")):
        vals = [r[i] for r in rows if r[i] is not None]
        if not vals:
            assert not any(k[0] == c for k in got)
            continue
        for p, w in zip(PROBS, np.quantile(np.array(vals, dtype=float), PROBS)):
            assert abs(got[(c, p)] - w) <= 1e-9 * max(1.0, abs(w)), (c, p)


def test_order_summary_with_duplicated_parent_matches_row_join(spark):
    so, si = _frames(spark)
    so2 = so.unionByName(so.where("order_id = 'o1'"))  # o1 listed twice
    got = {r["order_id"]: (r["items"], r["distinct_products"], str(r["total_price"]))
           for r in P.order_summary(so2, si).collect()}
    o, i = _pandas(so2)[["order_id"]], _pandas(si)
    m = o.merge(i, on="order_id", how="inner")
    want = m.groupby("order_id").agg(items=("order_item_id", "count"), products=("product_id", "nunique"),
                                     total=("price", "sum"))
    assert got == {k: (int(r["items"]), int(r["products"]), f"{r['total']:.2f}") for k, r in want.iterrows()}


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("slices", [1, 16, 200])
def test_percentiles_do_not_depend_on_the_plan(spark, reuse, adaptive, slices):
    df = spark.range(500).selectExpr("cast(if(id % 5 = 0, -id, id * id * 1.7) as double) as x").repartition(7)
    values = np.array([r["x"] for r in df.collect()])
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        got = {r["p"]: r["value"] for r in exact_percentiles(df, "x", PROBS, slices=slices).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS})
