"""Registered queries: one per operator of the pipeline, each with its DuckDB oracle.

Every query reads the benchmark tables of ``sf_dir`` in full (through the Bronze
adapters) and returns a lazy DataFrame. Columns are aliased identically on both
sides; at the edge money is DECIMAL(38,2) and timestamps are text (see ``edge``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType

from strata.functions.convert import ts_text
from strata.operators import checks as C
from strata.operators import gold as G
from strata.operators import reconcile as R
from strata.operators import silver as S
from strata.plans import suites as U
from strata.plans import oracle_sql as Q
from strata.session import scratch_path
from strata.sources import adapters as A
from strata.sources import files as io

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def edge(df: DataFrame) -> DataFrame:
    """Comparable output: decimals as decimal(38,2), timestamps as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast(DecimalType(38, 2))
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = ts_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass
class Layers:
    """The whole pipeline over one benchmark directory, as lazy plans."""

    bronze_orders: DataFrame
    bronze_items: DataFrame
    orders: DataFrame
    items: DataFrame
    sales: DataFrame
    gold: DataFrame


def layers(spark: SparkSession, sf_dir: str, items_variant: str = "clean",
           orders_variant: str = "clean",
           statuses=A.BENCH_VALID_SALE_STATUSES) -> Layers:
    bo = A.bronze_orders(spark, sf_dir, orders_variant)
    bi = A.bronze_order_items(spark, sf_dir, items_variant)
    so = S.orders(bo)
    si = S.order_items(bi)
    sales = S.order_product_sales(si, so)
    return Layers(bo, bi, so, si, sales, G.daily_product_sales(sales, statuses))


def held(lay: Layers, statuses=A.BENCH_VALID_SALE_STATUSES) -> Layers:
    """The same layers with sales written once, and Gold once from what was written: checks that read them several times
    build neither again."""
    spark = lay.sales.sparkSession
    root = scratch_path(spark, "held")
    at = lambda name, df: io.read_table(spark, io.publish(df, f"{root}/{name}"))
    sales = at("order_product_sales", lay.sales)
    return replace(lay, sales=sales, gold=at("daily_product_sales", G.daily_product_sales(sales, statuses)))


# --- B1-B6: Silver typing ---------------------------------------------------

_SILVER_ORDERS_SELECT = ("SELECT order_id, customer_id, order_status, purchase_date, "
                         + ", ".join(Q.ts(c) for c in (
                             "order_purchase_timestamp", "order_approved_at",
                             "order_delivered_carrier_date", "order_delivered_customer_date",
                             "order_estimated_delivery_date"))
                         + " FROM silver_orders")

_SILVER_ITEMS_SELECT = (f"SELECT order_id, order_item_id, product_id, seller_id, "
                        f"{Q.ts('shipping_limit_date')}, {Q.money('price')}, "
                        f"{Q.money('freight_value')} FROM silver_items")


@register("silver_orders", Q.with_(Q.ORDERS_, _SILVER_ORDERS_SELECT))
def silver_orders(spark, sf_dir):
    return edge(S.orders(A.bronze_orders(spark, sf_dir)))


@register("silver_orders_dirty", Q.with_([Q.BRONZE_ORDERS_DIRTY, Q.SILVER_ORDERS],
                                         _SILVER_ORDERS_SELECT))
def silver_orders_dirty(spark, sf_dir):
    return edge(S.orders(A.bronze_orders(spark, sf_dir, "dirty")))


@register("silver_order_items", Q.with_(Q.ITEMS, _SILVER_ITEMS_SELECT))
def silver_order_items(spark, sf_dir):
    return edge(S.order_items(A.bronze_order_items(spark, sf_dir)))


@register("silver_items_dirty", Q.with_([Q.BRONZE_ITEMS_DIRTY, Q.SILVER_ITEMS],
                                        _SILVER_ITEMS_SELECT))
def silver_items_dirty(spark, sf_dir):
    return edge(S.order_items(A.bronze_order_items(spark, sf_dir, "dirty")))


# --- C1/D1: grain change + order context -------------------------------------

_SALES_SELECT = ("SELECT order_id, product_id, purchase_date, order_status, quantity, "
                 f"{Q.money('unit_price')}, {Q.money('item_revenue')}, {Q.money('freight_total')} "
                 "FROM sales")


@register("order_product_sales", Q.with_(Q.SILVER, _SALES_SELECT))
def order_product_sales(spark, sf_dir):
    return edge(layers(spark, sf_dir).sales)


@register("order_product_sales_orphans",
          Q.with_([Q.BRONZE_ITEMS, Q.SILVER_ITEMS, Q.BRONZE_ORDERS_ORPHANS, Q.SILVER_ORDERS, Q.SALES],
                  _SALES_SELECT))
def order_product_sales_orphans(spark, sf_dir):
    return edge(layers(spark, sf_dir, orders_variant="orphans").sales)


# --- A7, B10, D2: staging and Gold -------------------------------------------

@register("stg_order_product_sales", Q.with_(Q.SILVER, _SALES_SELECT))
def stg_order_product_sales(spark, sf_dir):
    return edge(G.staging(layers(spark, sf_dir).sales))


@register("valid_sales", Q.with_(Q.SILVER, _SALES_SELECT + " WHERE order_status IN ('F')"))
def valid_sales(spark, sf_dir):
    return edge(G.valid_sales(layers(spark, sf_dir).sales, A.BENCH_VALID_SALE_STATUSES))


_GOLD_SELECT = ("SELECT purchase_date, product_id, quantity, "
                f"{Q.money('total_revenue')}, {Q.money('total_freight')}, orders_count FROM gold")


@register("daily_product_sales", Q.with_(Q.ALL, _GOLD_SELECT))
def daily_product_sales(spark, sf_dir):
    return edge(layers(spark, sf_dir).gold)


# --- F1-F11: generic checks ----------------------------------------------------

CHECK_COLUMNS = ("check", "table_name", "severity", "result", "affected_rows")
DIRTY = [Q.BRONZE_ITEMS_DIRTY, Q.SILVER_ITEMS, Q.BRONZE_ORDERS_DIRTY, Q.SILVER_ORDERS]
ORPHANS = [Q.BRONZE_ITEMS, Q.SILVER_ITEMS, Q.BRONZE_ORDERS_ORPHANS, Q.SILVER_ORDERS, Q.SALES]
P0, P1 = A.BENCH_PERIOD


def results(checks) -> DataFrame:
    return C.evaluate(checks).select(*CHECK_COLUMNS)


@register("check_not_null", Q.with_(DIRTY, Q.union(
    Q.not_null("silver_items", "price", "order_items"),
    Q.not_null("silver_items", "shipping_limit_date", "order_items"),
    Q.not_null("silver_orders", "order_status", "orders"),
    Q.not_null("silver_orders", "purchase_date", "orders"))))
def check_not_null(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    return results([C.not_null(lay.items, "price", "order_items"),
                    C.not_null(lay.items, "shipping_limit_date", "order_items"),
                    C.not_null(lay.orders, "order_status", "orders"),
                    C.not_null(lay.orders, "purchase_date", "orders")])


@register("check_unique", Q.with_(Q.SILVER, Q.union(
    Q.unique("silver_items", ["order_id", "order_item_id"], "order_items"),
    Q.unique("silver_orders", ["order_id"], "orders"),
    Q.unique("sales", ["order_id", "product_id"], "order_product_sales"),
    Q.unique("silver_items", ["product_id"], "order_items"))))
def check_unique(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return results([C.unique(lay.items, ["order_id", "order_item_id"], "order_items"),
                    C.unique(lay.orders, ["order_id"], "orders"),
                    C.unique(lay.sales, ["order_id", "product_id"], "order_product_sales"),
                    C.unique(lay.items, ["product_id"], "order_items")])


@register("check_non_negative", Q.with_(DIRTY, Q.union(
    Q.non_negative("silver_items", "price", "order_items"),
    Q.non_negative("silver_items", "freight_value", "order_items"))))
def check_non_negative(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    return results([C.non_negative(lay.items, "price", "order_items"),
                    C.non_negative(lay.items, "freight_value", "order_items")])


@register("check_greater_than", Q.with_(DIRTY + [Q.SALES], Q.union(
    Q.greater_than("sales", "quantity", 1, "order_product_sales"),
    Q.greater_than("silver_items", "price", 0, "order_items"))))
def check_greater_than(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    return results([C.greater_than(lay.sales, "quantity", 1, "order_product_sales"),
                    C.greater_than(lay.items, "price", 0, "order_items")])


@register("check_referential_integrity", Q.with_(ORPHANS, Q.union(
    Q.referential("sales", "silver_orders", "order_id", "order_product_sales", "orders"),
    Q.referential("silver_items", "silver_orders", "order_id", "order_items", "orders"))))
def check_referential_integrity(spark, sf_dir):
    lay = layers(spark, sf_dir, orders_variant="orphans")
    return results([C.referential_integrity(lay.sales, lay.orders, "order_id", "order_product_sales", "orders"),
                    C.referential_integrity(lay.items, lay.orders, "order_id", "order_items", "orders")])


@register("check_constant_in_group", Q.with_(Q.ITEMS, Q.union(
    Q.constant_in_group("silver_items", ["order_id", "product_id"], "price", "order_items"),
    Q.constant_in_group("silver_items", ["order_id"], "seller_id", "order_items"))))
def check_constant_in_group(spark, sf_dir):
    items = S.order_items(A.bronze_order_items(spark, sf_dir))
    return results([C.constant_in_group(items, ["order_id", "product_id"], "price", "order_items"),
                    C.constant_in_group(items, ["order_id"], "seller_id", "order_items")])


def _range_sql(src, col, table):
    d = f"cast({col} AS DATE)"
    out = f"{d} < DATE '{P0}' OR {d} > DATE '{P1}'"
    return (f"SELECT r.*, (SELECT cast(min({col}) AS VARCHAR) FROM {src} WHERE {out}) AS out_of_range_min, "
            f"(SELECT cast(max({col}) AS VARCHAR) FROM {src} WHERE {out}) AS out_of_range_max "
            f"FROM ({Q.date_range(src, col, P0, P1, table)}) r")


@register("check_date_range", Q.with_(Q.ITEMS + Q.ORDERS_, Q.union(
    _range_sql("silver_items", "shipping_limit_date", "order_items"),
    _range_sql("silver_orders", "order_purchase_timestamp", "orders"))))
def check_date_range(spark, sf_dir):
    lay = layers(spark, sf_dir)
    res = C.evaluate([C.date_range(lay.items, "shipping_limit_date", P0, P1, "order_items"),
                      C.date_range(lay.orders, "order_purchase_timestamp", P0, P1, "orders")])
    return res.select(*CHECK_COLUMNS, F.col("details")["min"].alias("out_of_range_min"),
                      F.col("details")["max"].alias("out_of_range_max"))


@register("check_keys_without_match", Q.with_(Q.SILVER, Q.union(
    Q.keys_without_match("silver_orders", "sales", "order_id", "orders", "order_product_sales"),
    Q.keys_without_match("silver_items", "silver_orders", "order_id", "order_items", "orders"))))
def check_keys_without_match(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return results([C.keys_without_match(lay.orders, lay.sales, "order_id", "orders", "order_product_sales"),
                    C.keys_without_match(lay.items, lay.orders, "order_id", "order_items", "orders")])


@register("check_expected_count", Q.with_(ORPHANS, Q.union(
    Q.expected_count("units_reconciled_with_order_items", "order_product_sales",
                     "SELECT sum(quantity) FROM sales", "SELECT count(*) FROM silver_items"),
    Q.expected_count("orders_match_source", "orders",
                     "SELECT count(*) FROM silver_orders", "SELECT count(*) FROM orders"),
    Q.expected_count("sales_match_items", "order_product_sales",
                     "SELECT count(*) FROM sales", "SELECT count(*) FROM silver_items"),
    Q.expected_count("placed_sales_match_items", "order_product_sales",
                     "SELECT count(purchase_date) FROM sales", "SELECT count(*) FROM silver_items"))))
def check_expected_count(spark, sf_dir):
    lay = layers(spark, sf_dir, orders_variant="orphans")
    source_orders = A.read_table(spark, sf_dir, "orders")
    return results([
        C.expected_count("units_reconciled_with_order_items", "order_product_sales",
                         C.sum_metric(lay.sales, "quantity"), C.row_count(lay.items)),
        C.expected_count("orders_match_source", "orders",
                         C.row_count(lay.orders), C.row_count(source_orders)),
        C.expected_count("sales_match_items", "order_product_sales",
                         C.row_count(lay.sales), C.row_count(lay.items)),
        C.expected_count("placed_sales_match_items", "order_product_sales",
                         C.rows_metric(lay.sales, F.count("purchase_date")), C.row_count(lay.items)),
    ])


# --- G2-G10: suites and data contracts ------------------------------------------

def _orders_suite_sql(src="silver_orders"):
    return [Q.not_null(src, "order_id", "orders"), Q.unique(src, ["order_id"], "orders"),
            Q.not_null(src, "order_status", "orders"), Q.not_null(src, "purchase_date", "orders"),
            Q.date_range(src, "order_purchase_timestamp", P0, P1, "orders")]


def _items_suite_sql(src="silver_items"):
    t = "order_items"
    return [Q.not_null(src, "order_id", t), Q.not_null(src, "product_id", t),
            Q.not_null(src, "order_item_id", t), Q.unique(src, ["order_id", "order_item_id"], t),
            Q.not_null(src, "price", t), Q.non_negative(src, "price", t),
            Q.non_negative(src, "freight_value", t),
            Q.constant_in_group(src, ["order_id", "product_id"], "price", t),
            Q.date_range(src, "shipping_limit_date", P0, P1, t)]


def _sales_suite_sql():
    t = "order_product_sales"
    return [Q.unique("sales", ["order_id", "product_id"], t),
            Q.greater_than("sales", "quantity", 0, t),
            Q.non_negative("sales", "item_revenue", t), Q.non_negative("sales", "freight_total", t),
            Q.referential("sales", "silver_orders", "order_id", t, "orders"),
            Q.not_null("sales", "purchase_date", t), Q.not_null("sales", "order_status", t),
            Q.expected_count("units_reconciled_with_order_items", t,
                             "SELECT coalesce(sum(quantity), 0) FROM sales",
                             "SELECT count(*) FROM silver_items"),
            Q.keys_without_match("silver_orders", "sales", "order_id", "orders", t)]


@register("suite_orders", Q.with_(Q.ORDERS_, Q.union(*_orders_suite_sql())))
def suite_orders(spark, sf_dir):
    return results(U.orders_suite(S.orders(A.bronze_orders(spark, sf_dir)), A.BENCH_PERIOD))


@register("suite_order_items", Q.with_(Q.ITEMS, Q.union(*_items_suite_sql())))
def suite_order_items(spark, sf_dir):
    return results(U.order_items_suite(S.order_items(A.bronze_order_items(spark, sf_dir)),
                                       A.BENCH_PERIOD))


@register("suite_order_items_dirty", Q.with_([Q.BRONZE_ITEMS_DIRTY, Q.SILVER_ITEMS],
                                             Q.union(*_items_suite_sql())))
def suite_order_items_dirty(spark, sf_dir):
    return results(U.order_items_suite(S.order_items(A.bronze_order_items(spark, sf_dir, "dirty")),
                                       A.BENCH_PERIOD))


@register("suite_order_product_sales", Q.with_(Q.SILVER, Q.union(*_sales_suite_sql())))
def suite_order_product_sales(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return results(U.sales_suite(lay.sales, lay.items, lay.orders))


@register("quality_summary", Q.with_(Q.SILVER, (
    "SELECT count(*) AS total, count(*) FILTER (WHERE result = 'OK') AS ok, "
    "count(*) FILTER (WHERE result = 'FAIL' AND severity = 'CRITICAL') AS critical_failed, "
    "count(*) FILTER (WHERE result = 'FAIL' AND severity = 'WARNING') AS warnings FROM ("
    + Q.union(*_orders_suite_sql(), *_items_suite_sql(), *_sales_suite_sql()) + ")")))
def quality_summary(spark, sf_dir):
    lay = layers(spark, sf_dir)
    checks = (U.orders_suite(lay.orders, A.BENCH_PERIOD)
              + U.order_items_suite(lay.items, A.BENCH_PERIOD)
              + U.sales_suite(lay.sales, lay.items, lay.orders))
    return C.summary(C.evaluate(checks))


_SILVER_CONTRACT_SQL = Q.union(
    Q.unique_values("silver_orders", "order_id", "orders"),
    *[Q.not_null("silver_orders", c, "orders") for c in ("order_id", "purchase_date", "order_status")],
    *[Q.not_null("silver_items", c, "order_items") for c in ("order_id", "product_id", "price")],
    *[Q.not_null("sales", c, "order_product_sales") for c in (
        "order_id", "product_id", "quantity", "item_revenue", "purchase_date", "order_status")])


@register("suite_silver_contract", Q.with_(Q.SILVER, _SILVER_CONTRACT_SQL))
def suite_silver_contract(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return results(U.silver_contract(lay.orders, lay.items, lay.sales))


_GOLD_CONTRACT_SQL = Q.union(
    *[Q.not_null("gold", c, "daily_product_sales") for c in (
        "purchase_date", "product_id", "quantity", "total_revenue", "total_freight", "orders_count")],
    *[Q.not_null("sales", c, "stg_order_product_sales") for c in ("order_id", "product_id")])


@register("suite_gold_contract", Q.with_(Q.ALL, _GOLD_CONTRACT_SQL))
def suite_gold_contract(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return results(U.gold_contract(lay.gold, G.staging(lay.sales)))


_GRAIN_SQL = ("SELECT purchase_date, product_id, count(*) AS records FROM gold "
              "GROUP BY purchase_date, product_id HAVING count(*) > 1")
_METRIC_SQL = ("SELECT purchase_date, product_id, quantity, cast(total_revenue AS DECIMAL(38,2)) "
               "AS total_revenue, cast(total_freight AS DECIMAL(38,2)) AS total_freight FROM gold "
               "WHERE quantity < 1 OR total_revenue < 0 OR total_freight < 0")


@register("gold_grain_violations", Q.with_(Q.ALL, _GRAIN_SQL))
def gold_grain_violations(spark, sf_dir):
    return G.grain_violations(layers(spark, sf_dir).gold)


@register("gold_metric_violations", Q.with_(Q.ALL, _METRIC_SQL))
def gold_metric_violations(spark, sf_dir):
    return edge(G.metric_violations(layers(spark, sf_dir).gold))


_RECON_SELECT = (
    "SELECT units_gold, units_silver, revenue_gold, revenue_silver FROM ("
    "SELECT (SELECT cast(coalesce(sum(quantity), 0) AS BIGINT) FROM gold) AS units_gold, "
    "(SELECT cast(coalesce(sum(quantity), 0) AS BIGINT) FROM sales WHERE order_status IN ('F')) AS units_silver, "
    "(SELECT cast(coalesce(sum(total_revenue), 0) AS DECIMAL(38,2)) FROM gold) AS revenue_gold, "
    "(SELECT cast(coalesce(sum(item_revenue), 0) AS DECIMAL(38,2)) FROM sales WHERE order_status IN ('F')) "
    "AS revenue_silver) t "
    "WHERE units_gold <> units_silver OR abs(revenue_gold - revenue_silver) > 0.01")


@register("gold_reconciliation", Q.with_(Q.ALL, _RECON_SELECT))
def gold_reconciliation(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return edge(U.reconciliation_violations(lay.gold, lay.sales, A.BENCH_VALID_SALE_STATUSES))


@register("gold_reconciliation_drift", Q.with_(Q.SILVER + [Q.gold(("F", "O"))], _RECON_SELECT))
def gold_reconciliation_drift(spark, sf_dir):
    """Gold built with a wider status list than the one Silver is compared under."""
    lay = layers(spark, sf_dir, statuses=("F", "O"))
    return edge(U.reconciliation_violations(lay.gold, lay.sales, A.BENCH_VALID_SALE_STATUSES))


@register("gold_reconciliation_empty", Q.with_(Q.SILVER + [Q.gold(())], _RECON_SELECT))
def gold_reconciliation_empty(spark, sf_dir):
    """A Gold without rows against a Silver with sales: one difference, not a pass."""
    lay = layers(spark, sf_dir, statuses=())
    return edge(U.reconciliation_violations(lay.gold, lay.sales, A.BENCH_VALID_SALE_STATUSES))


_GOLD_TESTS_SQL = Q.union(
    Q.no_rows("grain_purchase_date_product_id", "daily_product_sales", _GRAIN_SQL),
    Q.no_rows("metrics_positive", "daily_product_sales", _METRIC_SQL),
    Q.no_rows("reconciled_with_silver", "daily_product_sales", _RECON_SELECT))


@register("gold_tests", Q.with_(Q.ALL, _GOLD_TESTS_SQL))
def gold_tests(spark, sf_dir):
    lay = held(layers(spark, sf_dir))
    return results(U.gold_tests(lay.gold, lay.sales, A.BENCH_VALID_SALE_STATUSES))


# Variants in which the tests and contracts above find something: dirty extracts (negative
# prices, NULL prices, dates and statuses), a Gold whose rows occur twice, and orphans.

DIRTY_ALL = DIRTY + [Q.SALES, Q.GOLD]
_TWICE = "SELECT * FROM gold0 UNION ALL SELECT * FROM gold0"
TWICE = Q.SILVER + [Q.GOLD.replace("gold AS", "gold0 AS", 1), f"gold AS ({_TWICE})"]


def _twice(lay: Layers) -> DataFrame:
    return lay.gold.unionByName(lay.gold)


@register("gold_grain_violations_twice", Q.with_(TWICE, _GRAIN_SQL))
def gold_grain_violations_twice(spark, sf_dir):
    return G.grain_violations(_twice(layers(spark, sf_dir)))


@register("gold_metric_violations_dirty", Q.with_(DIRTY_ALL, _METRIC_SQL))
def gold_metric_violations_dirty(spark, sf_dir):
    return edge(G.metric_violations(layers(spark, sf_dir, "dirty", "dirty").gold))


@register("gold_tests_twice", Q.with_(TWICE, _GOLD_TESTS_SQL))
def gold_tests_twice(spark, sf_dir):
    lay = held(layers(spark, sf_dir))
    return results(U.gold_tests(_twice(lay), lay.sales, A.BENCH_VALID_SALE_STATUSES))


@register("gold_tests_dirty", Q.with_(DIRTY_ALL, _GOLD_TESTS_SQL))
def gold_tests_dirty(spark, sf_dir):
    lay = held(layers(spark, sf_dir, "dirty", "dirty"))
    return results(U.gold_tests(lay.gold, lay.sales, A.BENCH_VALID_SALE_STATUSES))


@register("suite_silver_contract_dirty", Q.with_(DIRTY + [Q.SALES], _SILVER_CONTRACT_SQL))
def suite_silver_contract_dirty(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    return results(U.silver_contract(lay.orders, lay.items, lay.sales))


@register("suite_gold_contract_dirty", Q.with_(
    DIRTY + [Q.SALES, Q.gold(("F", "P"))], _GOLD_CONTRACT_SQL))
def suite_gold_contract_dirty(spark, sf_dir):
    """Dirty extracts with a status whose orders lack a date: Gold has NULL dates and revenues."""
    lay = layers(spark, sf_dir, "dirty", "dirty", statuses=("F", "P"))
    return results(U.gold_contract(lay.gold, G.staging(lay.sales)))


# --- H1-H7: cross-layer reconciliation ------------------------------------------

def _frames(lay: Layers) -> R.LayerFrames:
    return R.LayerFrames(lay.bronze_orders, lay.bronze_items, lay.orders, lay.items,
                         lay.sales, lay.gold)


_VALID = "(SELECT * FROM sales WHERE order_status IN ('F'))"
_METRICS_SQL = f"""metrics AS (SELECT
  (SELECT count(*) FROM bronze_orders) AS bronze_orders_rows,
  (SELECT count(*) FROM bronze_items) AS bronze_items_rows,
  (SELECT count(*) FROM silver_orders) AS silver_orders_rows,
  (SELECT count(*) FROM silver_items) AS silver_items_rows,
  (SELECT count(*) FROM sales) AS silver_sales_rows,
  (SELECT count(*) FROM (SELECT DISTINCT order_id, product_id FROM sales)) AS silver_sales_keys,
  (SELECT cast(coalesce(sum(quantity), 0) AS BIGINT) FROM sales) AS silver_sales_units,
  (SELECT count(*) FROM {_VALID}) AS silver_sales_sold_rows,
  (SELECT cast(coalesce(sum(quantity), 0) AS BIGINT) FROM {_VALID}) AS silver_sales_sold_units,
  (SELECT cast(coalesce(sum(item_revenue), 0) AS DECIMAL(38,2)) FROM {_VALID}) AS silver_sales_sold_revenue,
  (SELECT count(*) FROM gold) AS gold_daily_rows,
  (SELECT count(*) FROM (SELECT DISTINCT purchase_date, product_id FROM gold)) AS gold_daily_keys,
  (SELECT cast(coalesce(sum(quantity), 0) AS BIGINT) FROM gold) AS gold_daily_units,
  (SELECT cast(coalesce(sum(total_revenue), 0) AS DECIMAL(38,2)) FROM gold) AS gold_daily_revenue,
  (SELECT count(*) FROM (SELECT DISTINCT product_id FROM gold)) AS gold_daily_products,
  (SELECT count(*) FROM (SELECT DISTINCT purchase_date FROM gold)) AS gold_daily_days)"""


@register("layer_metrics", Q.with_(Q.ALL + [_METRICS_SQL], "SELECT * FROM metrics"))
def layer_metrics(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return R.LayerMetrics(_frames(lay), A.BENCH_VALID_SALE_STATUSES).frame()


@register("layer_summary", Q.with_(Q.ALL + [_METRICS_SQL], """
SELECT 'bronze' AS layer, 'orders' AS table_name, bronze_orders_rows AS rows, NULL::BIGINT AS units,
       NULL::DECIMAL(38,2) AS revenue, NULL::BIGINT AS days, NULL::BIGINT AS products,
       NULL::BIGINT AS discarded_units, NULL::DOUBLE AS discarded_pct FROM metrics
UNION ALL SELECT 'bronze', 'order_items', bronze_items_rows, NULL, NULL, NULL, NULL, NULL, NULL FROM metrics
UNION ALL SELECT 'silver', 'orders', silver_orders_rows, NULL, NULL, NULL, NULL, NULL, NULL FROM metrics
UNION ALL SELECT 'silver', 'order_items', silver_items_rows, silver_items_rows, NULL, NULL, NULL,
       NULL, NULL FROM metrics
UNION ALL SELECT 'silver', 'order_product_sales', silver_sales_rows, silver_sales_units, silver_sales_sold_revenue,
       NULL, NULL, NULL, NULL FROM metrics
UNION ALL SELECT 'gold', 'daily_product_sales', gold_daily_rows, gold_daily_units, gold_daily_revenue, gold_daily_days, gold_daily_products,
       silver_sales_units - gold_daily_units,
       round((silver_sales_units - gold_daily_units) * 100.0 / nullif(silver_sales_units, 0), 2) FROM metrics"""))
def layer_summary(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return R.layer_summary(R.LayerMetrics(_frames(lay), A.BENCH_VALID_SALE_STATUSES).frame())


def _equal_sql(left, right, table):
    return Q.expected_count(f"{left}_equal_{right}", table, f"SELECT {left} FROM metrics", f"SELECT {right} FROM metrics")


_SILVER_LAYER_SQL = (
    _equal_sql("silver_orders_rows", "bronze_orders_rows", "orders"),
    _equal_sql("silver_items_rows", "bronze_items_rows", "order_items"),
    _equal_sql("silver_sales_units", "silver_items_rows", "order_product_sales"),
    _equal_sql("silver_sales_rows", "silver_sales_keys", "order_product_sales"))
_GOLD_LAYER_SQL = (
    _equal_sql("gold_daily_rows", "gold_daily_keys", "daily_product_sales"),
    _equal_sql("gold_daily_units", "silver_sales_sold_units", "daily_product_sales"),
    Q.check("gold_daily_revenue_close_silver_sales_sold_revenue", "daily_product_sales", "CRITICAL",
            "SELECT 0", "(SELECT abs(gold_daily_revenue - silver_sales_sold_revenue) <= 0.01 FROM metrics)"),
    Q.check("gold_daily_units_at_most_silver_sales_units", "daily_product_sales", "CRITICAL",
            "SELECT 0", "(SELECT gold_daily_units <= silver_sales_units FROM metrics)"))


def published(lay: Layers, root: str, statuses=A.BENCH_VALID_SALE_STATUSES) -> Layers:
    """The layers written as tables and read back, each built from those before: what a reconciliation compares."""
    spark = lay.sales.sparkSession
    at = lambda name, df: io.read_table(spark, io.publish(df, f"{root}/{name}"))
    orders, items = at("orders", lay.orders), at("order_items", lay.items)
    sales = at("order_product_sales", S.order_product_sales(items, orders))
    gold = at("daily_product_sales", G.daily_product_sales(sales, statuses))
    return Layers(lay.bronze_orders, lay.bronze_items, orders, items, sales, gold)


@register("reconcile_layers", Q.with_(Q.ALL + [_METRICS_SQL], Q.union(*_SILVER_LAYER_SQL, *_GOLD_LAYER_SQL)))
def reconcile_layers(spark, sf_dir):
    """Bronze extracts against published Silver and Gold tables."""
    lay = published(layers(spark, sf_dir), scratch_path(spark, "layers"))
    m = R.LayerMetrics(_frames(lay), A.BENCH_VALID_SALE_STATUSES)
    return results(R.layer_checks(m, R.THROUGH_GOLD))


_BROKEN = [Q.BRONZE_ITEMS, Q.SILVER_ITEMS, Q.BRONZE_ORDERS,
           Q.SILVER_ORDERS.replace("silver_orders AS", "silver_orders0 AS", 1),
           "silver_orders AS (SELECT * FROM silver_orders0 WHERE order_status <> 'P')",
           Q.SALES.replace("sales AS", "sales0 AS", 1),
           "sales AS (SELECT * FROM sales0 UNION ALL SELECT * FROM sales0 WHERE order_status = 'O')",
           Q.gold(("F", "O")).replace("gold AS", "gold0 AS", 1), f"gold AS ({_TWICE})"]


@register("reconcile_layers_broken", Q.with_(_BROKEN + [_METRICS_SQL], Q.union(*_SILVER_LAYER_SQL, *_GOLD_LAYER_SQL)))
def reconcile_layers_broken(spark, sf_dir):
    """Layers that disagree: orders lost, sales rows repeated, Gold of other statuses and written twice."""
    lay = layers(spark, sf_dir)
    orders = lay.orders.filter("order_status <> 'P'")
    once = S.order_product_sales(lay.items, orders)
    sales = once.unionByName(once.filter("order_status = 'O'"))
    gold = G.daily_product_sales(sales, ("F", "O"))
    broken = Layers(lay.bronze_orders, lay.bronze_items, orders, lay.items, sales, gold.unionByName(gold))
    return results(R.layer_checks(R.LayerMetrics(_frames(broken), A.BENCH_VALID_SALE_STATUSES), R.THROUGH_GOLD))


# Profiling and source/sink queries register themselves on import (they use the
# helpers above, so they are imported last).
from strata.plans import catalog_io  # noqa: E402,F401
from strata.plans import catalog_profile  # noqa: E402,F401
