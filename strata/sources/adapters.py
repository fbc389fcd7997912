"""Benchmark tables -> Bronze-shaped text frames (orders, order items).

The pipeline's input is two text extracts (every column a string). The benchmark
ships typed Parquet tables instead, so these adapters derive the Bronze shape from
them with plain projections (and one aggregate + join for the carrier date). They run
over whole tables; the variants only change values, they never drop or sample rows.

Mapping:

- orders.order_id / customer_id / order_status <- o_orderkey / o_custkey / o_orderstatus
- orders.order_purchase_timestamp <- o_orderdate formatted ``yyyy-MM-dd HH:mm:ss``
- orders.order_delivered_carrier_date <- latest l_shipdate of the order (NULL without items)
- other order dates: NULL
- items.order_id / order_item_id / product_id / seller_id <- l_orderkey / l_linenumber /
  l_partkey / l_suppkey
- items.shipping_limit_date <- l_shipdate formatted
- items.price <- l_extendedprice as decimal(10,2) text; freight_value <- l_quantity likewise

Variants (fixed rules, mirrored by the oracle SQL):

- ``dirty`` items: price ``'bad'`` where l_quantity = 1, shipping date ``'not-a-date'``
  where l_quantity = 2, price negated where l_quantity = 3.
- ``dirty`` orders: purchase timestamp ``'not-a-date'`` where status 'P' and priority
  '1-URGENT'; status NULL where status 'O' and priority '2-HIGH'.
- ``orphans`` orders: those of priority '5-LOW' have an ``X`` before their order_id, so
  their items have no parent and they have no items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.convert import ts_text
from strata.sources.schemas import MONEY, ORDER_ITEMS_COLUMNS, ORDERS_COLUMNS

# Fixed values of the variants (see module docstring).
DIRTY_PRICE_QUANTITY = 1
DIRTY_DATE_QUANTITY = 2
NEGATIVE_PRICE_QUANTITY = 3
ORPHAN_PRIORITY = "5-LOW"
BAD_PRICE = "bad"
BAD_DATE = "not-a-date"

# Statuses of the benchmark orders table that count as a sale, and the period its
# order dates cover; used as the Gold and date-range parameters on this data.
BENCH_VALID_SALE_STATUSES = ("F",)
BENCH_PERIOD = ("1995-01-01", "2001-08-01")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(c) -> F.Column:
    return F.col(c).cast(MONEY).cast("string")


def bronze_order_items(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    price = _money_text("l_extendedprice")
    shipping = ts_text("l_shipdate")
    if variant == "dirty":
        q = F.col("l_quantity")
        price = (F.when(q == DIRTY_PRICE_QUANTITY, F.lit(BAD_PRICE))
                 .when(q == NEGATIVE_PRICE_QUANTITY, F.concat(F.lit("-"), price))
                 .otherwise(price))
        shipping = F.when(q == DIRTY_DATE_QUANTITY, F.lit(BAD_DATE)).otherwise(shipping)
    elif variant != "clean":
        raise ValueError(f"unknown items variant {variant!r}")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        shipping.alias("shipping_limit_date"),
        price.alias("price"),
        _money_text("l_quantity").alias("freight_value"),
    ).select(*ORDER_ITEMS_COLUMNS)


def bronze_orders(spark: SparkSession, sf_dir: str, variant: str = "clean") -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    if variant not in ("clean", "dirty", "orphans"):
        raise ValueError(f"unknown orders variant {variant!r}")
    # One row per order before the join: partial aggregation map-side, then a join of
    # two order-grained inputs.
    last_ship = (read_table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey").agg(F.max("l_shipdate").alias("_last_ship")))
    j = o.join(last_ship, o["o_orderkey"] == last_ship["l_orderkey"], "left")

    status = F.col("o_orderstatus")
    purchase = ts_text("o_orderdate")
    if variant == "dirty":
        prio = F.col("o_orderpriority")
        purchase = F.when((status == "P") & (prio == "1-URGENT"), F.lit(BAD_DATE)).otherwise(purchase)
        status = F.when((status == "O") & (prio == "2-HIGH"), F.lit(None)).otherwise(status)
    none = F.lit(None).cast("string")
    order_id = F.col("o_orderkey").cast("string")
    if variant == "orphans":
        order_id = F.when(F.col("o_orderpriority") == ORPHAN_PRIORITY, F.concat(F.lit("X"), order_id)).otherwise(order_id)
    return j.select(
        order_id.alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        status.alias("order_status"),
        purchase.alias("order_purchase_timestamp"),
        none.alias("order_approved_at"),
        ts_text("_last_ship").alias("order_delivered_carrier_date"),
        none.alias("order_delivered_customer_date"),
        none.alias("order_estimated_delivery_date"),
    ).select(*ORDERS_COLUMNS)
