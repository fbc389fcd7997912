"""DuckDB SQL fragments that restate the pipeline over the benchmark tables.

Used as the independent oracle for every registered query: each query's SQL is a
``WITH`` over the fragments it needs plus a final ``SELECT``. Money is compared as
DECIMAL(38,2) and timestamps as ``yyyy-MM-dd HH:mm:ss`` text on both sides.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"


def _money_text(c: str) -> str:
    return f"cast(cast({c} AS DECIMAL(10,2)) AS VARCHAR)"


BRONZE_ITEMS = f"""bronze_items AS (
  SELECT cast(l_orderkey AS VARCHAR) AS order_id,
         cast(l_linenumber AS VARCHAR) AS order_item_id,
         cast(l_partkey AS VARCHAR) AS product_id,
         cast(l_suppkey AS VARCHAR) AS seller_id,
         strftime(l_shipdate, {TS}) AS shipping_limit_date,
         {_money_text('l_extendedprice')} AS price,
         {_money_text('l_quantity')} AS freight_value
  FROM lineitem)"""

BRONZE_ITEMS_DIRTY = f"""bronze_items AS (
  SELECT cast(l_orderkey AS VARCHAR) AS order_id,
         cast(l_linenumber AS VARCHAR) AS order_item_id,
         cast(l_partkey AS VARCHAR) AS product_id,
         cast(l_suppkey AS VARCHAR) AS seller_id,
         CASE WHEN l_quantity = 2 THEN 'not-a-date' ELSE strftime(l_shipdate, {TS}) END
           AS shipping_limit_date,
         CASE WHEN l_quantity = 1 THEN 'bad'
              WHEN l_quantity = 3 THEN '-' || {_money_text('l_extendedprice')}
              ELSE {_money_text('l_extendedprice')} END AS price,
         {_money_text('l_quantity')} AS freight_value
  FROM lineitem)"""


def _bronze_orders(dirty: bool = False, orphans: bool = False) -> str:
    order_id = "cast(o_orderkey AS VARCHAR)"
    if orphans:
        order_id = f"CASE WHEN o_orderpriority = '5-LOW' THEN 'X' || {order_id} ELSE {order_id} END"
    status = "o_orderstatus"
    purchase = f"strftime(o_orderdate, {TS})"
    if dirty:
        status = ("CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN NULL "
                  "ELSE o_orderstatus END")
        purchase = (f"CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' "
                    f"THEN 'not-a-date' ELSE {purchase} END")
    return f"""last_ship AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey),
bronze_orders AS (
  SELECT {order_id} AS order_id,
         cast(o_custkey AS VARCHAR) AS customer_id,
         {status} AS order_status,
         {purchase} AS order_purchase_timestamp,
         cast(NULL AS VARCHAR) AS order_approved_at,
         strftime(last_ship, {TS}) AS order_delivered_carrier_date,
         cast(NULL AS VARCHAR) AS order_delivered_customer_date,
         cast(NULL AS VARCHAR) AS order_estimated_delivery_date
  FROM orders LEFT JOIN last_ship ON o_orderkey = l_orderkey)"""


BRONZE_ORDERS = _bronze_orders()
BRONZE_ORDERS_DIRTY = _bronze_orders(dirty=True)
BRONZE_ORDERS_ORPHANS = _bronze_orders(orphans=True)

SILVER_ITEMS = f"""silver_items AS (
  SELECT order_id,
         try_cast(order_item_id AS INTEGER) AS order_item_id,
         product_id,
         seller_id,
         try_strptime(shipping_limit_date, {TS}) AS shipping_limit_date,
         try_cast(price AS DECIMAL(10,2)) AS price,
         try_cast(freight_value AS DECIMAL(10,2)) AS freight_value
  FROM bronze_items)"""

SILVER_ORDERS = f"""silver_orders AS (
  SELECT order_id, customer_id, order_status,
         cast(try_strptime(order_purchase_timestamp, {TS}) AS DATE) AS purchase_date,
         try_strptime(order_purchase_timestamp, {TS}) AS order_purchase_timestamp,
         try_strptime(order_approved_at, {TS}) AS order_approved_at,
         try_strptime(order_delivered_carrier_date, {TS}) AS order_delivered_carrier_date,
         try_strptime(order_delivered_customer_date, {TS}) AS order_delivered_customer_date,
         try_strptime(order_estimated_delivery_date, {TS}) AS order_estimated_delivery_date
  FROM bronze_orders)"""

SALES = """product_lines AS (
  SELECT order_id, product_id,
         cast(count(*) AS INTEGER) AS quantity,
         max(price) AS unit_price,
         sum(price) AS item_revenue,
         sum(freight_value) AS freight_total
  FROM silver_items GROUP BY order_id, product_id),
sales AS (
  SELECT p.order_id, p.product_id, o.purchase_date, o.order_status,
         p.quantity, p.unit_price, p.item_revenue, p.freight_total
  FROM product_lines p LEFT JOIN silver_orders o ON p.order_id = o.order_id)"""


def gold(statuses=("F",)) -> str:
    in_list = ", ".join(f"'{s}'" for s in statuses) or "NULL"
    return f"""gold AS (
  SELECT purchase_date, product_id,
         cast(sum(quantity) AS BIGINT) AS quantity,
         sum(item_revenue) AS total_revenue,
         sum(freight_total) AS total_freight,
         count(DISTINCT order_id) AS orders_count
  FROM sales WHERE order_status IN ({in_list})
  GROUP BY purchase_date, product_id)"""


GOLD = gold()

# Common stacks.
ITEMS = [BRONZE_ITEMS, SILVER_ITEMS]
ORDERS_ = [BRONZE_ORDERS, SILVER_ORDERS]
SILVER = [BRONZE_ITEMS, SILVER_ITEMS, BRONZE_ORDERS, SILVER_ORDERS, SALES]
ALL = SILVER + [GOLD]


def with_(ctes, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def ts(c: str, alias: str | None = None) -> str:
    return f"strftime({c}, {TS}) AS {alias or c.split('.')[-1]}"


def money(c: str, alias: str | None = None) -> str:
    return f"cast({c} AS DECIMAL(38,2)) AS {alias or c.split('.')[-1]}"


# --- check results, restated in SQL -------------------------------------------


def check(name: str, table: str, severity: str, affected: str, ok: str | None = None) -> str:
    """One result row: check, table_name, severity, result, affected_rows."""
    ok = ok or "a = 0"
    return (f"SELECT '{name}' AS \"check\", '{table}' AS table_name, '{severity}' AS severity, "
            f"CASE WHEN {ok} THEN 'OK' ELSE 'FAIL' END AS result, "
            f"cast(a AS BIGINT) AS affected_rows FROM (SELECT ({affected}) AS a) t")


def not_null(src, col, table, sev="CRITICAL"):
    return check(f"{col}_not_null", table, sev, f"SELECT count(*) FROM {src} WHERE {col} IS NULL")


def unique(src, cols, table, sev="CRITICAL"):
    k = ", ".join(cols)
    return check(f"unique_{'_'.join(cols)}", table, sev,
                 f"(SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT {k} FROM {src}))")


def unique_values(src, col, table, sev="CRITICAL"):
    return check(f"unique_{col}", table, sev,
                 f"SELECT count(*) FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1)")


def non_negative(src, col, table, sev="CRITICAL"):
    return check(f"{col}_non_negative", table, sev, f"SELECT count(*) FROM {src} WHERE {col} < 0")


def greater_than(src, col, minimum, table, sev="CRITICAL"):
    return check(f"{col}_greater_than_{minimum}", table, sev,
                 f"SELECT count(*) FROM {src} WHERE {col} IS NULL OR {col} <= {minimum}")


def referential(child, parent, col, table, parent_table, sev="CRITICAL"):
    return check(f"{col}_exists_in_{parent_table}", table, sev,
                 f"SELECT count(*) FROM {child} c WHERE NOT EXISTS "
                 f"(SELECT 1 FROM {parent} p WHERE p.{col} = c.{col})")


def constant_in_group(src, group, col, table, sev="CRITICAL"):
    g = ", ".join(group)
    return check(f"{col}_constant_per_{'_'.join(group)}", table, sev,
                 f"SELECT count(*) FROM (SELECT {g} FROM {src} GROUP BY {g} "
                 f"HAVING count(DISTINCT {col}) > 1)")


def date_range(src, col, start, end, table, sev="WARNING"):
    d = f"cast({col} AS DATE)"
    return check(f"{col}_in_range", table, sev,
                 f"SELECT count(*) FROM {src} WHERE {d} < DATE '{start}' OR {d} > DATE '{end}'")


def keys_without_match(left, right, col, table, right_table, sev="WARNING"):
    return check(f"{col}_matched_in_{right_table}", table, sev,
                 f"SELECT count(*) FROM (SELECT DISTINCT {col} FROM {left}) l WHERE NOT EXISTS "
                 f"(SELECT 1 FROM {right} r WHERE r.{col} = l.{col})")


def expected_count(name, table, actual, expected, sev="CRITICAL"):
    return check(name, table, sev, f"abs(({actual}) - ({expected}))")


def no_rows(name, table, query, sev="CRITICAL"):
    return check(name, table, sev, f"SELECT count(*) FROM ({query})")


def union(*selects) -> str:
    return "\nUNION ALL\n".join(selects)
