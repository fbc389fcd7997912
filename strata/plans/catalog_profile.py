"""Registered profiling queries (exploration operators) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import profile as P
from strata.plans import oracle_sql as Q
from strata.plans.catalog import DIRTY, ORPHANS, edge, layers, register

ORDERS_TEXT = ("order_id", "customer_id", "order_status")
ITEMS_TEXT = ("order_id", "product_id", "seller_id")
ORDER_COLS = ("order_id", "customer_id", "order_status", "purchase_date", *P.ORDER_TIMESTAMP_COLUMNS)
ITEM_COLS = ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
             "price", "freight_value")


def _dbl(x: str) -> str:
    return f"cast({x} AS DOUBLE)"


def _pct(part: str, whole: str) -> str:
    return f"round({_dbl(part)} * 100.0 / {_dbl(f'nullif({whole}, 0)')}, 2)"


# --- D9-D12 --------------------------------------------------------------------

def _keys_sql(src, table, cols):
    return [f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, "
            f"count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) = count(*) AS is_key FROM {src}"
            for c in cols]


@register("profile_keys", Q.with_(Q.ITEMS + Q.ORDERS_, Q.union(
    *_keys_sql("silver_orders", "orders", ORDERS_TEXT),
    *_keys_sql("silver_items", "order_items", ITEMS_TEXT))))
def profile_keys(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return P.keys(lay.orders, "orders", ORDERS_TEXT).unionByName(
        P.keys(lay.items, "order_items", ITEMS_TEXT))


@register("profile_status_distribution", Q.with_(Q.ORDERS_, (
    "SELECT order_status, count(*) AS rows, "
    + _pct("count(*)", "(SELECT count(*) FROM silver_orders WHERE order_status IS NOT NULL)")
    + " AS pct FROM silver_orders WHERE order_status IS NOT NULL GROUP BY order_status")))
def profile_status_distribution(spark, sf_dir):
    return P.value_distribution(layers(spark, sf_dir).orders, "order_status")


@register("profile_date_ranges", Q.with_(Q.ORDERS_, Q.union(*[
    f"SELECT '{c}' AS column_name, strftime(min({c}), {Q.TS}) AS min_value, "
    f"strftime(max({c}), {Q.TS}) AS max_value, count(*) FILTER (WHERE {c} IS NULL) AS nulls "
    f"FROM silver_orders" for c in P.ORDER_TIMESTAMP_COLUMNS])))
def profile_date_ranges(spark, sf_dir):
    return P.date_ranges(layers(spark, sf_dir).orders)


@register("profile_orders_by_month", Q.with_(Q.ORDERS_ + [
    f"monthly AS (SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month, count(*) AS orders "
    f"FROM silver_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1)"],
    "SELECT month, orders, (SELECT min(month) FROM monthly) AS first_month, "
    "(SELECT max(month) FROM monthly) AS last_month FROM monthly"))
def profile_orders_by_month(spark, sf_dir):
    return P.orders_by_month(layers(spark, sf_dir).orders)


# --- D13-D15 --------------------------------------------------------------------

def _numeric_sql(src, c):
    x = _dbl(c)
    return (f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS std, round({_dbl(f'min({c})')}, 4) AS min, "
            + ", ".join(f"round(quantile_cont({x}, {p}), 4) AS {n}"
                        for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
            + f", round({_dbl(f'max({c})')}, 4) AS max FROM {src}")


@register("profile_numeric_summary", Q.with_(Q.ITEMS, Q.union(
    *[_numeric_sql("silver_items", c) for c in ("order_item_id", "price", "freight_value")])))
def profile_numeric_summary(spark, sf_dir):
    return P.numeric_summary(layers(spark, sf_dir).items, ["order_item_id", "price", "freight_value"])


def _text_sql(src, c):
    top = (f"FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} ASC LIMIT 1")
    return (f"SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS distinct_values, "
            f"(SELECT {c} {top}) AS top, (SELECT count(*) {top}) AS freq FROM {src}")


@register("profile_text_summary", Q.with_(Q.ORDERS_ + Q.ITEMS, Q.union(
    *[f"SELECT 'orders' AS table_name, t.* FROM ({_text_sql('silver_orders', c)}) t" for c in ORDERS_TEXT],
    *[f"SELECT 'order_items' AS table_name, t.* FROM ({_text_sql('silver_items', c)}) t" for c in ITEMS_TEXT])))
def profile_text_summary(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return P.text_summary(lay.orders, ORDERS_TEXT).withColumn("table_name", F.lit("orders")).unionByName(
        P.text_summary(lay.items, ITEMS_TEXT).withColumn("table_name", F.lit("order_items")))


def _dates_sql(src, table, c):
    seconds = f"epoch(cast({c} AS TIMESTAMP))"
    text = lambda x: f"strftime(make_timestamp(cast(floor({x}) AS BIGINT) * 1000000), {Q.TS})"
    return (f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS count, "
            f"{text(f'min({seconds})')} AS min_value, "
            + ", ".join(f"{text(f'quantile_cont({seconds}, {p})')} AS {n}_value"
                        for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
            + f", {text(f'max({seconds})')} AS max_value FROM {src}")


ORDER_DATES = ("purchase_date", *P.ORDER_TIMESTAMP_COLUMNS)


@register("profile_date_summary", Q.with_(Q.ORDERS_ + Q.ITEMS, Q.union(
    *[_dates_sql("silver_orders", "orders", c) for c in ORDER_DATES],
    _dates_sql("silver_items", "order_items", "shipping_limit_date"))))
def profile_date_summary(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return P.date_summary(lay.orders, ORDER_DATES).withColumn("table_name", F.lit("orders")).unionByName(
        P.date_summary(lay.items, ["shipping_limit_date"]).withColumn("table_name", F.lit("order_items")))


@register("profile_price_percentiles", Q.with_(Q.ITEMS, Q.union(*[
    f"SELECT cast({p} AS DOUBLE) AS p, round(quantile_cont(cast(price AS DOUBLE), {p}), 4) AS price "
    f"FROM silver_items" for p in P.PRICE_PROBS])))
def profile_price_percentiles(spark, sf_dir):
    return P.price_percentiles(layers(spark, sf_dir).items)


@register("profile_items_per_order", Q.with_(Q.ITEMS + [
    "per_order AS (SELECT order_id, count(*) AS items FROM silver_items "
    "WHERE order_id IS NOT NULL GROUP BY order_id)"],
    "SELECT items, count(*) AS orders, (SELECT round(avg(items), 2) FROM per_order) AS avg_items, "
    "(SELECT max(items) FROM per_order) AS max_items FROM per_order GROUP BY items"))
def profile_items_per_order(spark, sf_dir):
    return P.items_per_order(layers(spark, sf_dir).items)


# --- D16-D18 --------------------------------------------------------------------

def _nulls_sql(src, table, cols):
    return [f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"{_pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS pct FROM {src}"
            for c in cols]


@register("profile_nulls", Q.with_(DIRTY, Q.union(
    *_nulls_sql("silver_orders", "orders", ORDER_COLS),
    *_nulls_sql("silver_items", "order_items", ITEM_COLS))))
def profile_nulls(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    return P.nulls(lay.orders, "orders").unionByName(P.nulls(lay.items, "order_items"))


def _columns_sql(src, table, cols):
    return [f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS column_name, count({c}) AS non_null FROM {src}"
            for i, c in enumerate(cols)]


@register("profile_columns", Q.with_(DIRTY, Q.union(
    *_columns_sql("silver_orders", "orders", ORDER_COLS),
    *_columns_sql("silver_items", "order_items", ITEM_COLS))))
def profile_columns(spark, sf_dir):
    lay = layers(spark, sf_dir, "dirty", "dirty")
    # Types are Spark's own and pinned by a test; the oracle compares what it can count itself.
    return P.columns_info(lay.orders, "orders").unionByName(
        P.columns_info(lay.items, "order_items")).drop("data_type")


def _dups_sql(src, table, key):
    k = ", ".join(key)
    return [f"SELECT '{table}' AS table_name, 'full_row' AS duplicate_kind, "
            f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src})) "
            f"AS duplicate_rows",
            f"SELECT '{table}' AS table_name, '({k})' AS duplicate_kind, "
            f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {src})) "
            f"AS duplicate_rows"]


@register("profile_duplicates", Q.with_(Q.ITEMS + Q.ORDERS_, Q.union(
    *_dups_sql("silver_orders", "orders", ["order_id"]),
    *_dups_sql("silver_items", "order_items", ["order_id", "order_item_id"]))))
def profile_duplicates(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return P.duplicates(lay.orders, "orders", ["order_id"]).unionByName(
        P.duplicates(lay.items, "order_items", ["order_id", "order_item_id"]))


@register("profile_anomalies", Q.with_([Q.BRONZE_ITEMS_DIRTY, Q.SILVER_ITEMS], (
    "SELECT count(*) FILTER (WHERE order_id IS NULL) AS null_order_id, "
    "count(*) FILTER (WHERE product_id IS NULL) AS null_product_id, "
    "count(*) FILTER (WHERE price IS NULL) AS null_price, "
    "count(*) FILTER (WHERE price <= 0) AS price_not_positive, "
    "count(*) FILTER (WHERE freight_value < 0) AS freight_negative FROM silver_items")))
def profile_anomalies(spark, sf_dir):
    return P.anomalies(layers(spark, sf_dir, "dirty").items)


# --- D19-D21 --------------------------------------------------------------------

_ORDER_SUMMARY = ("SELECT i.order_id, count(i.order_item_id) AS items, "
                  "count(DISTINCT i.product_id) AS distinct_products, "
                  "count(DISTINCT i.seller_id) AS distinct_sellers, "
                  "cast(sum(i.price) AS DECIMAL(38,2)) AS total_price "
                  "FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id GROUP BY i.order_id")


@register("order_summary", Q.with_(Q.ITEMS + Q.ORDERS_, _ORDER_SUMMARY))
def order_summary(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return edge(P.order_summary(lay.orders, lay.items))


_PAIRS = ("pairs AS (SELECT order_id, product_id, count(*) AS quantity FROM silver_items "
          "WHERE order_id IS NOT NULL AND product_id IS NOT NULL GROUP BY order_id, product_id)")


@register("profile_repeated_products", Q.with_(Q.ITEMS + [_PAIRS], (
    "SELECT quantity, count(*) AS pairs, (SELECT count(*) FROM pairs) AS total_pairs, "
    "(SELECT count(*) FROM pairs WHERE quantity > 1) AS repeated_pairs, "
    + _pct("(SELECT count(*) FROM pairs WHERE quantity > 1)", "(SELECT count(*) FROM pairs)")
    + " AS repeated_pct FROM pairs WHERE quantity > 1 GROUP BY quantity")))
def profile_repeated_products(spark, sf_dir):
    return P.repeated_products(layers(spark, sf_dir).items)


_CONSISTENCY = ("SELECT order_id, product_id, count(*) AS rows, count(DISTINCT price) AS distinct_prices, "
                "cast(min(price) AS DECIMAL(38,2)) AS min_price, cast(max(price) AS DECIMAL(38,2)) AS max_price, "
                "cast(sum(price) AS DECIMAL(38,2)) AS total_price FROM silver_items "
                "WHERE order_id IS NOT NULL AND product_id IS NOT NULL "
                "GROUP BY order_id, product_id HAVING count(*) > 1")


@register("profile_price_consistency", Q.with_(Q.ITEMS, _CONSISTENCY))
def profile_price_consistency(spark, sf_dir):
    return edge(P.price_consistency(layers(spark, sf_dir).items))


@register("profile_price_consistency_summary", Q.with_(Q.ITEMS, (
    "SELECT count(*) AS repeated_pairs, count(*) FILTER (WHERE distinct_prices = 1) AS single_price_pairs "
    f"FROM ({_CONSISTENCY})")))
def profile_price_consistency_summary(spark, sf_dir):
    return P.price_consistency_summary(layers(spark, sf_dir).items)


# --- C5-C8, E6 --------------------------------------------------------------------

@register("orders_items_inner", Q.with_(Q.ITEMS + Q.ORDERS_, (
    f"SELECT o.order_id, {Q.ts('o.order_purchase_timestamp')}, o.order_status, i.product_id, "
    f"i.order_item_id, {Q.money('i.price')} FROM silver_orders o JOIN silver_items i "
    f"ON o.order_id = i.order_id")))
def orders_items_inner(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return edge(P.orders_items(lay.orders, lay.items))


@register("join_coverage", Q.with_(ORPHANS, (
    "SELECT CASE WHEN o.m IS NOT NULL AND i.m IS NOT NULL THEN 'both' "
    "WHEN o.m IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS side, count(*) AS rows "
    "FROM (SELECT order_id, 1 AS m FROM silver_orders) o FULL OUTER JOIN "
    "(SELECT order_id, 1 AS m FROM silver_items) i ON o.order_id IS NOT DISTINCT FROM i.order_id "
    "GROUP BY 1")))
def join_coverage(spark, sf_dir):
    lay = layers(spark, sf_dir, orders_variant="orphans")
    return P.join_coverage(lay.orders, lay.items)


@register("multi_item_orders", Q.with_(Q.ITEMS, (
    f"SELECT order_id, order_item_id, product_id, seller_id, {Q.ts('shipping_limit_date')}, "
    f"{Q.money('price')}, {Q.money('freight_value')} FROM silver_items WHERE order_id IN "
    f"(SELECT order_id FROM silver_items GROUP BY order_id HAVING count(*) > 1)")))
def multi_item_orders(spark, sf_dir):
    return edge(P.multi_item_orders(layers(spark, sf_dir).items))


@register("orders_without_items_by_status", Q.with_(Q.ITEMS + Q.ORDERS_, (
    "SELECT order_status, count(*) AS orders FROM silver_orders o WHERE NOT EXISTS "
    "(SELECT 1 FROM silver_items i WHERE i.order_id = o.order_id) AND order_status IS NOT NULL "
    "GROUP BY order_status")))
def orders_without_items_by_status(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return P.orders_without_items_by_status(lay.orders, lay.items)


@register("key_set_difference", Q.with_(ORPHANS, (
    "SELECT 'items_not_in_orders' AS direction, (SELECT count(*) FROM (SELECT order_id FROM silver_items "
    "EXCEPT SELECT order_id FROM silver_orders)) AS keys UNION ALL "
    "SELECT 'orders_not_in_items', (SELECT count(*) FROM (SELECT order_id FROM silver_orders "
    "EXCEPT SELECT order_id FROM silver_items))")))
def key_set_difference(spark, sf_dir):
    lay = layers(spark, sf_dir, orders_variant="orphans")
    return P.key_set_difference(lay.orders, lay.items)


# --- E2-E4: previews and top-k -----------------------------------------------------

@register("gold_preview", Q.with_(Q.ALL, (
    f"SELECT purchase_date, product_id, quantity, {Q.money('total_revenue')}, {Q.money('total_freight')}, "
    "orders_count FROM gold ORDER BY purchase_date, product_id LIMIT 10")))
def gold_preview(spark, sf_dir):
    return edge(P.preview(layers(spark, sf_dir).gold, 10))


@register("top_priced_items", Q.with_(Q.ITEMS, (
    f"SELECT order_id, order_item_id, product_id, {Q.money('price')}, {Q.money('freight_value')} "
    "FROM silver_items ORDER BY price DESC NULLS LAST, order_id, order_item_id, product_id, "
    "freight_value LIMIT 5")))
def top_priced_items(spark, sf_dir):
    return edge(P.top_priced_items(layers(spark, sf_dir).items, 5))


@register("top_orders_by_items", Q.with_(Q.ITEMS + Q.ORDERS_, (
    f"SELECT * FROM ({_ORDER_SUMMARY}) ORDER BY items DESC, order_id LIMIT 10")))
def top_orders_by_items(spark, sf_dir):
    lay = layers(spark, sf_dir)
    return edge(P.top_orders_by_items(lay.orders, lay.items, 10))


@register("top_repeated_pairs", Q.with_(Q.ITEMS + [_PAIRS], (
    "SELECT order_id, product_id, quantity FROM pairs WHERE quantity > 1 "
    "ORDER BY quantity DESC, order_id, product_id LIMIT 3")))
def top_repeated_pairs(spark, sf_dir):
    return P.top_repeated_pairs(layers(spark, sf_dir).items, 3)


@register("most_repeated_orders", Q.with_(Q.ITEMS + [_PAIRS], (
    f"SELECT order_id, order_item_id, product_id, seller_id, {Q.ts('shipping_limit_date')}, {Q.money('price')}, "
    f"{Q.money('freight_value')} FROM silver_items WHERE order_id IN (SELECT order_id FROM pairs "
    "GROUP BY order_id ORDER BY max(quantity) DESC, order_id LIMIT 3)")))
def most_repeated_orders(spark, sf_dir):
    return edge(P.most_repeated_orders(layers(spark, sf_dir).items, 3))
