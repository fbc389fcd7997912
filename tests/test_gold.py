import datetime as dt
from decimal import Decimal

from strata.operators import checks as C
from strata.operators import gold as G
from strata.operators import reconcile as R
from strata.operators import silver as S
from strata.plans import suites as U
from tests.fixtures import item, items, order, orders


def _layers(spark):
    bi = items(spark, [
        item("o1", "1", "p1", price="100.00", freight="10.12"),
        item("o1", "2", "p1", price="100.00", freight="10.12"),
        item("o2", "1", "p1", price="100.00", freight="5.00"),
        item("o3", "1", "p2", price="49.90", freight="7.50"),
        item("o4", "1", "p2", price="20.00", freight="1.00"),
    ])
    bo = orders(spark, [order("o1", "delivered", "2018-01-15 08:00:00"),
                        order("o2", "delivered", "2018-01-15 09:30:00"),
                        order("o3", "shipped", "2018-01-15 10:00:00"),
                        order("o4", None, "2018-01-16 10:00:00")])
    so, si = S.orders(bo), S.order_items(bi)
    return bo, bi, so, si, S.order_product_sales(si, so)


def test_daily_model_for_delivered(spark):
    *_, sales = _layers(spark)
    rows = G.daily_product_sales(sales, ["delivered"]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["purchase_date"] == dt.date(2018, 1, 15) and r["product_id"] == "p1"
    assert r["quantity"] == 3 and r["orders_count"] == 2
    assert r["total_revenue"] == Decimal("300.00") and r["total_freight"] == Decimal("25.24")


def test_status_list_is_a_parameter(spark):
    *_, sales = _layers(spark)
    got = {(r["product_id"], r["quantity"]) for r in G.daily_product_sales(sales, ["delivered", "shipped"]).collect()}
    assert got == {("p1", 3), ("p2", 1)}
    assert G.daily_product_sales(sales, []).count() == 0  # empty list keeps nothing
    # a NULL status never counts as a sale
    assert G.valid_sales(sales, ["delivered", "shipped"]).where("order_id = 'o4'").count() == 0


def test_gold_schema(spark):
    *_, sales = _layers(spark)
    types = {f.name: f.dataType.simpleString() for f in G.daily_product_sales(sales, ["delivered"]).schema.fields}
    assert types["quantity"] == "bigint" and types["orders_count"] == "bigint"
    assert types["purchase_date"] == "date"


def test_gold_tests_pass_and_reconcile(spark):
    *_, sales = _layers(spark)
    gold = G.daily_product_sales(sales, ["delivered"])
    rows = C.evaluate(U.gold_contract(gold, G.staging(sales)) + U.gold_tests(gold, sales, ["delivered"])).collect()
    assert len(rows) == 11 and all(r["result"] == "OK" for r in rows)


def test_reconciliation_detects_drift(spark):
    *_, sales = _layers(spark)
    gold = G.daily_product_sales(sales, ["delivered", "shipped"])
    v = U.reconciliation_violations(gold, sales, ["delivered"]).collect()
    assert len(v) == 1 and v[0]["units_gold"] == 4 and v[0]["units_silver"] == 3


def test_grain_and_metric_violations(spark):
    *_, sales = _layers(spark)
    gold = G.daily_product_sales(sales, ["delivered"])
    doubled = gold.unionByName(gold)
    assert G.grain_violations(doubled).count() == 1
    neg = gold.selectExpr("purchase_date", "product_id", "0L as quantity", "total_revenue",
                          "total_freight", "orders_count")
    assert G.metric_violations(neg).count() == 1


def test_layer_checks_and_summary(spark):
    bo, bi, so, si, sales = _layers(spark)
    gold = G.daily_product_sales(sales, ["delivered"])
    m = R.LayerMetrics(R.LayerFrames(bo, bi, so, si, sales, gold), ["delivered"])
    rows = C.evaluate(R.layer_checks(m)).collect()
    assert len(rows) == 8 and all(r["result"] == "OK" for r in rows), rows
    assert len(C.evaluate(R.layer_checks(m, R.SILVER_ONLY)).collect()) == 4
    summary = {(r["layer"], r["table_name"]): r for r in R.layer_summary(m.frame()).collect()}
    g = summary[("gold", "daily_product_sales")]
    assert g["units"] == 3 and g["discarded_units"] == 2 and g["discarded_pct"] == 40.0
    assert g["days"] == 1 and g["products"] == 1


def test_layer_checks_catch_lost_rows(spark):
    bo, bi, so, si, sales = _layers(spark)
    m = R.LayerMetrics(R.LayerFrames(bo, bi, so, si.where("order_id != 'o4'"), sales, None))
    rows = {r["check"]: r for r in C.evaluate(R.layer_checks(m, R.SILVER_ONLY)).collect()}
    assert rows["silver_items_rows_equal_bronze_items_rows"]["affected_rows"] == 1


def test_gold_tests_detect_each_violation(spark):
    *_, sales = _layers(spark)
    gold = G.daily_product_sales(sales, ["delivered"])
    doubled = gold.unionByName(gold)
    rows = {r["check"]: r["affected_rows"] for r in C.evaluate(U.gold_tests(doubled, sales, ["delivered"])).collect()}
    assert rows == {"grain_purchase_date_product_id": 1, "metrics_positive": 0, "reconciled_with_silver": 1}
    neg = gold.selectExpr("purchase_date", "product_id", "0L as quantity", "total_revenue",
                          "total_freight", "orders_count")
    rows = {r["check"]: r["affected_rows"] for r in C.evaluate(U.gold_tests(neg, sales, ["delivered"])).collect()}
    assert rows["metrics_positive"] == 1 and rows["reconciled_with_silver"] == 1
