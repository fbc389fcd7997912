import os

from strata.operators import checks as C
from strata.plans import jobs as J
from strata.sources import files as io
from tests.fixtures import item, items, order, orders

PERIOD = ("2016-09-01", "2018-10-31")


def _land(spark, root, item_rows, order_rows):
    io.write_csv(orders(spark, order_rows), f"{root}/bronze/orders")
    io.write_csv(items(spark, item_rows), f"{root}/bronze/items")
    return f"{root}/bronze/orders", f"{root}/bronze/items"


GOOD_ITEMS = [item("o1", "1", "p1"), item("o1", "2", "p1"), item("o2", "1", "p2", price="49.90")]
GOOD_ORDERS = [order("o1", "delivered", "2018-01-15 08:00:00"), order("o2", "shipped", "2018-02-20 09:30:00"),
               order("o3", "unavailable", "2018-03-01 10:00:00")]


def test_full_run_publishes_and_validates(spark, tmp_uri):
    o, i = _land(spark, tmp_uri, GOOD_ITEMS, GOOD_ORDERS)
    assert J.validate_bronze(spark, o, i).exit_code == 0
    out = J.run_silver(spark, o, i, f"{tmp_uri}/silver", report=f"{tmp_uri}/report", period=PERIOD)
    assert out.status == "OK" and out.exit_code == 0 and len(out.results) == 5 + 9 + 9
    assert io.read_table(spark, f"{tmp_uri}/silver/order_product_sales").count() == 2
    gold = J.build_gold(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold", f"{tmp_uri}/export", ["delivered"])
    assert gold.status == "OK", gold.error
    g = io.read_table(spark, f"{tmp_uri}/gold/daily_product_sales").collect()
    assert len(g) == 1 and g[0]["quantity"] == 2
    assert os.path.isdir(f"{tmp_uri}/export/daily_product_sales.csv")
    v = J.validate_layers(spark, o, i, f"{tmp_uri}/silver", f"{tmp_uri}/gold", "gold", ["delivered"])
    assert v.status == "OK" and len(v.results) == 8
    assert J.validate_layers(spark, o, i, f"{tmp_uri}/silver", None, "silver").results.__len__() == 4
    rep = C.read_report(spark, f"{tmp_uri}/report")
    assert rep.count() == 23 and {r["status"] for r in rep.collect()} == {"OK"}


def test_critical_failure_stops_before_publish_and_is_reported(spark, tmp_uri):
    bad = GOOD_ITEMS + [item("o2", "1", "p2", price="49.90")]  # duplicate (order_id, order_item_id)
    o, i = _land(spark, tmp_uri, bad, GOOD_ORDERS)
    out = J.run_silver(spark, o, i, f"{tmp_uri}/silver", report=f"{tmp_uri}/report", period=PERIOD)
    assert out.status == "FAILED" and out.exit_code == 1
    assert os.path.isdir(f"{tmp_uri}/silver/orders")          # orders were published (per table)
    assert not os.path.exists(f"{tmp_uri}/silver/order_items")  # items were not
    failed = [r for r in C.read_report(spark, f"{tmp_uri}/report").collect() if r["result"] == "FAIL"]
    assert any(r["check"] == "unique_order_id_order_item_id" for r in failed)


def test_missing_extract_stops_the_run_before_anything_is_written(spark, tmp_uri):
    out = J.run_silver(spark, f"{tmp_uri}/nope/orders", f"{tmp_uri}/nope/items", f"{tmp_uri}/silver",
                       report=f"{tmp_uri}/report")
    assert out.status == "FAILED" and out.exit_code == 1 and not os.path.exists(f"{tmp_uri}/silver")
    rep = {r["check"]: r["result"] for r in C.read_report(spark, f"{tmp_uri}/report").collect()}
    assert rep == {"orders_landed": "FAIL", "order_items_landed": "FAIL"}


def test_unexpected_error_is_reported_as_error(spark, tmp_uri):
    out = J.build_gold(spark, f"{tmp_uri}/nope", f"{tmp_uri}/gold", report=f"{tmp_uri}/report")
    assert out.status == "ERROR" and out.exit_code == 1
    rep = C.read_report(spark, f"{tmp_uri}/report").collect()
    assert len(rep) == 1 and rep[0]["status"] == "ERROR" and rep[0]["check"] == "run"


def test_empty_gold_is_not_published_over_a_good_one(spark, tmp_uri):
    o, i = _land(spark, tmp_uri, GOOD_ITEMS, GOOD_ORDERS)
    assert J.run_silver(spark, o, i, f"{tmp_uri}/silver", period=PERIOD).status == "OK"
    build = lambda statuses: J.build_gold(spark, f"{tmp_uri}/silver", f"{tmp_uri}/gold", None, statuses)
    assert build(["delivered"]).status == "OK"
    out = build(["no such status"])
    assert out.status == "FAILED" and "gold_not_empty" in out.error
    assert io.read_table(spark, f"{tmp_uri}/gold/daily_product_sales").count() == 1
    assert os.listdir(f"{tmp_uri}/gold") == ["daily_product_sales"]


def test_severity_override_lets_a_run_go_on(spark, tmp_uri):
    o, i = _land(spark, tmp_uri, GOOD_ITEMS + [GOOD_ITEMS[0]], GOOD_ORDERS)
    out = J.run_silver(spark, o, i, f"{tmp_uri}/silver", period=PERIOD,
                       severities={"unique_order_id_order_item_id": C.WARNING})
    assert out.status == "OK" and len(out.results) == 23
    assert [r["severity"] for r in out.results if r["result"] == "FAIL"][0] == "WARNING"


def test_bronze_missing_column_and_missing_file(spark, tmp_uri):
    os.makedirs(f"{tmp_uri}/b/orders")
    with open(f"{tmp_uri}/b/orders/a.csv", "w") as f:
        f.write("order_id,customer_id\no1,c1\n")
    out = J.validate_bronze(spark, f"{tmp_uri}/b/orders", f"{tmp_uri}/b/missing")
    assert out.exit_code == 1
    by_name = {r["check"]: r for r in out.results}
    assert by_name["orders_expected_columns"]["result"] == "FAIL"
    assert by_name["orders_expected_columns"]["affected_rows"] == 6
    assert by_name["order_items_readable"]["result"] == "FAIL"
    assert "order_items_not_empty" not in by_name


def test_cli_exit_code(tmp_uri, spark):
    o, i = _land(spark, tmp_uri, GOOD_ITEMS, GOOD_ORDERS)
    assert J.main(["bronze", "--orders", o, "--items", i]) == 0


def test_single_table_runs(spark, tmp_uri):
    o, i = _land(spark, tmp_uri, GOOD_ITEMS, GOOD_ORDERS)
    silver = f"{tmp_uri}/silver"
    assert J.run_table(spark, "orders", silver, o, period=PERIOD).status == "OK"
    assert J.run_table(spark, "order_items", silver, i, period=PERIOD).status == "OK"
    out = J.main(["table", "--table", "order_product_sales", "--silver", silver])
    assert out == 0
    assert io.read_table(spark, f"{silver}/order_product_sales").count() == 2


def test_landing_is_verified_by_content_not_by_size(spark, tmp_uri):
    def put(side, dataset, name, text):
        os.makedirs(f"{tmp_uri}/{side}/{dataset}", exist_ok=True)
        with open(f"{tmp_uri}/{side}/{dataset}/{name}", "w", newline="") as f:
            f.write(text)

    for side in ("sent", "landed"):
        put(side, "orders", "a.csv", "order_id,price\no1,10.00\no2,12.00\n")
        put(side, "orders", "z.csv", "order_id,price\no7,1.00\n")
        put(side, "order_items", "b.csv", "order_id,price\no1,10.00\n")
    go = lambda: J.verify_landing(spark, f"{tmp_uri}/sent", f"{tmp_uri}/landed", report=f"{tmp_uri}/report")
    assert go().exit_code == 0
    put("landed", "orders", "a.csv", "order_id,price\no9,99.99\no2,12.00\n")   # as many bytes, other values
    put("landed", "order_items", "c.csv", "order_id,price\n")
    out = go()
    assert out.status == "FAILED" and out.exit_code == 1
    said = {r["check"]: (r["affected_rows"], r["message"]) for r in out.results}
    assert said == {"orders_unchanged": (1, "files same=1 changed=1 missing=0 unexpected=0"),
                    "order_items_unchanged": (1, "files same=1 changed=0 missing=0 unexpected=1")}
    put("landed", "orders", "a.csv", "order_id,price\r\no1,10.00\r\no2,12.00\r\n")   # other line ends
    assert "orders/orders_unchanged" in go().error
    assert J.main(["landing", "--source", f"{tmp_uri}/sent", "--landed", f"{tmp_uri}/sent"]) == 0
    assert J.main(["landing", "--source", f"{tmp_uri}/sent", "--landed", f"{tmp_uri}/sent", "--dataset", "returns"]) == 1
