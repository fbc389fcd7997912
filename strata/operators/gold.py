"""Silver -> Gold: the daily sales model per product.

The only business rule of the pipeline is which order statuses count as a sale; it is
one parameter (``valid_sale_statuses``), so changing it rebuilds Gold without
touching Silver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.schemas import SALES_COLUMNS


def staging(sales: DataFrame) -> DataFrame:
    """Stable names and order over Silver sales; no filter, no rule."""
    return sales.select(*SALES_COLUMNS)


def is_valid_sale(valid_sale_statuses: Sequence[str]) -> Column:
    """The business rule as a predicate: status in the list; an empty list matches nothing.

    A NULL status gives NULL, which ``filter``, ``when`` and ``count_if`` treat as false.
    Kept as a plain ``IN`` so that it is pushed down to the scan.
    """
    statuses = list(valid_sale_statuses)
    if not statuses:
        return F.lit(False)
    return F.col("order_status").isin(statuses)


def valid_sales(sales: DataFrame, valid_sale_statuses: Sequence[str]) -> DataFrame:
    """Rows whose status is in the list. NULL status never passes; an empty list keeps nothing."""
    return sales.filter(is_valid_sale(valid_sale_statuses))


def daily_product_sales(sales: DataFrame, valid_sale_statuses: Sequence[str]) -> DataFrame:
    """One row per (purchase_date, product_id) over valid sales.

    When ``sales`` is the lazy Silver plan, Catalyst pushes the status filter into the
    orders scan and turns the LEFT join into an INNER one; ``count_distinct`` runs as
    Spark's two-phase distinct aggregation (first on (date, product, order) with
    map-side combine, then per (date, product)), which also spreads a hot product.
    """
    return valid_sales(sales, valid_sale_statuses).groupBy("purchase_date", "product_id").agg(
        F.sum("quantity").cast("bigint").alias("quantity"),
        F.sum("item_revenue").alias("total_revenue"),
        F.sum("freight_total").alias("total_freight"),
        F.count_distinct("order_id").alias("orders_count"),
    )


def grain_violations(gold: DataFrame) -> DataFrame:
    """Keys of the model that appear more than once (must return nothing)."""
    return (gold.groupBy("purchase_date", "product_id")
            .agg(F.count(F.lit(1)).alias("records"))
            .filter(F.col("records") > 1))


def metric_violations(gold: DataFrame) -> DataFrame:
    """Rows with quantity < 1 or negative revenue/freight (must return nothing)."""
    return gold.filter((F.col("quantity") < 1) | (F.col("total_revenue") < 0)
                       | (F.col("total_freight") < 0)).select(
        "purchase_date", "product_id", "quantity", "total_revenue", "total_freight")
