"""Profiling operators: what the exploration of the two inputs looks at, as Spark jobs.

Each operator takes the typed Silver frames (``orders``, ``items``) and returns a
small, deterministic result frame. Conventions:

- value counts and distinct counts exclude NULL (like the exploration's pandas calls);
  where a NULL key matters (duplicates, join coverage) NULLs compare equal;
- percentages are rounded to 2 places, statistics to 4;
- global totals are window sums over the small histogram they belong to, so the input is
  aggregated once; no join of a one-row frame.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.convert import month_text, pct, ts_text
from strata.operators import checks as C
from strata.operators.quantiles import column_percentiles, exact_percentiles
from strata.operators.skew import spread_join
from strata.sources.schemas import ORDER_TIMESTAMP_COLUMNS

PRICE_PROBS = (0.01, 0.25, 0.50, 0.75, 0.95, 0.99, 1.00)


def _unpivot(row: DataFrame, structs: list[Column]) -> DataFrame:
    return row.select(F.inline(F.array(*structs)))


# --- D9: keys -------------------------------------------------------------------


def keys(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows and distinct values per column; ``is_key`` when distinct == rows.

    One scan: each row gives (column number, value), tasks reduce them to distinct values with their counts, and only
    those are shuffled, dealt by column and value. Rows are the sum of one column's counts.
    """
    kinds = {df.schema[c].dataType for c in columns}
    value = (lambda c: F.col(c)) if len(kinds) == 1 else (lambda c: F.to_json(F.struct(F.col(c).alias("v"))))
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("_c"), F.when(F.col(c).isNotNull(), value(c)).alias("_v")) for k, c in enumerate(columns)])))
    counted = cells.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # A row of no rows for each column, so that an empty table has its columns in the result.
    none = counted.sparkSession.range(len(columns)).select(
        F.col("id").cast("int").alias("_c"), F.lit(None).cast(counted.schema["_v"].dataType).alias("_v"),
        F.lit(0).cast("bigint").alias("_n"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_c") + 1)
    rows, distinct = F.sum("_n"), F.count("_v")
    return counted.unionByName(none).groupBy("_c").agg(
        rows.alias("rows"), distinct.alias("distinct_values")).select(
            F.lit(table).alias("table_name"), name.alias("column_name"), "rows", "distinct_values",
            (F.col("distinct_values") == F.col("rows")).alias("is_key"))


# --- D10: value distribution ----------------------------------------------------


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share % of each non-NULL value."""
    present = df.where(F.col(column).isNotNull())
    total = present.agg(F.count(F.lit(1))).scalar()
    return (present.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
            .select(column, "rows", pct(F.col("rows"), total).alias("pct")))


# --- D11/D12: dates -------------------------------------------------------------


def date_ranges(orders: DataFrame, columns: Sequence[str] = ORDER_TIMESTAMP_COLUMNS) -> DataFrame:
    """min, max and NULL count per date column (one aggregate pass, then unpivot)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}"),
                 F.count_if(F.col(c).isNull()).alias(f"_nul_{c}")]
    row = orders.agg(*aggs)
    return _unpivot(row, [
        F.struct(F.lit(c).alias("column_name"), ts_text(F.col(f"_min_{c}")).alias("min_value"),
                 ts_text(F.col(f"_max_{c}")).alias("max_value"), F.col(f"_nul_{c}").alias("nulls"))
        for c in columns])


def orders_by_month(orders: DataFrame, column: str = "order_purchase_timestamp") -> DataFrame:
    """Orders per purchase month (yyyy-MM), with the first and last month on every row."""
    monthly = (orders.where(F.col(column).isNotNull())
               .groupBy(month_text(column).alias("month"))
               .agg(F.count(F.lit(1)).alias("orders")))
    # Totals come from the histogram itself (a row a month), so the input is aggregated once.
    every = Window.partitionBy()
    return monthly.select("month", "orders", F.min("month").over(every).alias("first_month"),
                          F.max("month").over(every).alias("last_month"))


# --- D13/D14: summaries ---------------------------------------------------------


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max per column (rounded to 4).

    One aggregate pass for the moments of every column, one percentile pipeline for the
    quartiles of every column (exact, linear interpolation, see ``quantiles``); the two
    small results (one row per column each) are stacked and folded per column.
    """
    idx = {c: i for i, c in enumerate(columns)}
    aggs = []
    for c, i in idx.items():
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"count_{i}"), F.avg(x).alias(f"mean_{i}"),
                 F.stddev_samp(x).alias(f"std_{i}"), F.min(x).alias(f"min_{i}"),
                 F.max(x).alias(f"max_{i}")]
    stats = ("count", "mean", "std", "min", "max")
    moments = _unpivot(df.agg(*aggs), [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{k}_{i}").alias(k) for k in stats])
        for c, i in idx.items()])
    quartiles = column_percentiles(df, list(columns), (0.25, 0.5, 0.75)).groupBy("column_name").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    folded = moments.unionByName(quartiles, allowMissingColumns=True).groupBy("column_name").agg(
        *[F.max(k).alias(k) for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")])
    return folded.select("column_name", F.col("count").cast("bigint").alias("count"),
                         *[F.round(k, 4).alias(k) for k in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, distinct values, most frequent value (ties -> smallest value) and its frequency.

    All columns in one pass: values are counted per column name (map-side combined), then
    folded; the most frequent one is the least of (-frequency, value).
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns])).alias("e"))
    counted = (pairs.select("e.*").groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n")))
    present = F.col("v").isNotNull()
    folded = counted.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("count"),
        F.count("v").alias("distinct_values"),
        F.min(F.when(present, F.struct((-F.col("n")).alias("minus"), F.col("v").alias("top")))).alias("t"))
    return folded.select("column_name", "count", "distinct_values", F.col("t.top").alias("top"),
                         (-F.col("t.minus")).alias("freq"))


def date_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, min, quartiles and max of date columns as text; quartiles are of the seconds, rounded down."""
    seconds = {c: F.unix_timestamp(F.col(c).cast("timestamp_ntz").cast("timestamp")) for c in columns}
    frame = df.select(*[seconds[c].alias(c) for c in columns])
    row = frame.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns)
                      for n, f in (("count", F.count), ("min", F.min), ("max", F.max))])
    ends = _unpivot(row, [F.struct(F.lit(c).alias("column_name"), *[F.col(f"{n}_{i}").cast("double").alias(n)
                                                                    for n in ("count", "min", "max")])
                          for i, c in enumerate(columns)])
    quartiles = column_percentiles(frame, list(columns), (0.25, 0.5, 0.75)).groupBy("column_name").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    folded = ends.unionByName(quartiles, allowMissingColumns=True).groupBy("column_name").agg(
        *[F.max(k).alias(k) for k in ("count", "min", "p25", "p50", "p75", "max")])
    text = lambda k: ts_text(F.timestamp_seconds(F.floor(k)).cast("timestamp_ntz")).alias(f"{k}_value")
    return folded.select("column_name", F.col("count").cast("bigint").alias("count"),
                         *[text(k) for k in ("min", "p25", "p50", "p75", "max")])


def price_percentiles(items: DataFrame, probs: Sequence[float] = PRICE_PROBS) -> DataFrame:
    return exact_percentiles(items, "price", probs).select(
        "p", F.round("value", 4).alias("price"))


# --- D15/D19/D20/D21: per-order and per-pair shapes ---------------------------------


def items_per_order(items: DataFrame) -> DataFrame:
    """Histogram of items per order, with the mean (2 places) and max on every row."""
    per_order = items.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"))
    every = Window.partitionBy()
    mean = F.sum(F.col("items") * F.col("orders")).over(every) / F.sum("orders").over(every)
    return (per_order.groupBy("items").agg(F.count(F.lit(1)).alias("orders"))
            .select("items", "orders", F.round(mean, 2).alias("avg_items"),
                    F.max("items").over(every).alias("max_items")))


def order_summary(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Per order of the inner join orders x items: items, distinct products and sellers, total price.

    Computed without joining rows: items are aggregated per order (map-side combine, so a
    hot order is pre-aggregated) and joined to the number of order rows per key; an order
    listed k times multiplies counts and sums by k, exactly as the row join would.
    """
    # First per (order, product, seller), so that two distinct counts do not multiply the rows.
    shapes = items.groupBy("order_id", "product_id", "seller_id").agg(
        F.count("order_item_id").alias("_n"), F.sum("price").alias("_price"))
    per_order = shapes.groupBy("order_id").agg(
        F.sum("_n").alias("_items"),
        F.size(F.collect_set("product_id")).cast("bigint").alias("distinct_products"),
        F.size(F.collect_set("seller_id")).cast("bigint").alias("distinct_sellers"),
        F.sum("_price").alias("_total"),
    )
    copies = orders.groupBy("order_id").agg(F.count(F.lit(1)).alias("_k"))
    joined = per_order.join(copies, "order_id", "inner")
    total_type = per_order.schema["_total"].dataType
    return joined.select(
        "order_id",
        (F.col("_items") * F.col("_k")).alias("items"),
        "distinct_products",
        "distinct_sellers",
        (F.col("_total") * F.col("_k")).cast(total_type).alias("total_price"),
    )


def product_quantities(items: DataFrame) -> DataFrame:
    """Rows per (order_id, product_id) pair (the quantity), NULL keys excluded."""
    return (items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
            .groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("quantity")))


def repeated_products(items: DataFrame) -> DataFrame:
    """Histogram of quantity among pairs with quantity > 1, with pair totals and share %."""
    histogram = product_quantities(items).groupBy("quantity").agg(F.count(F.lit(1)).alias("pairs"))
    every = Window.partitionBy()
    counted = histogram.select(
        "quantity", "pairs", F.sum("pairs").over(every).alias("total_pairs"),
        F.sum(F.when(F.col("quantity") > 1, F.col("pairs"))).over(every).alias("repeated_pairs"))
    return counted.where(F.col("quantity") > 1).withColumn(
        "repeated_pct", pct(F.col("repeated_pairs"), F.col("total_pairs")))


def price_consistency(items: DataFrame) -> DataFrame:
    """Per repeated pair: rows, distinct prices, min, max and total price."""
    return (items.where(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())
            .groupBy("order_id", "product_id").agg(
                F.count(F.lit(1)).alias("rows"),
                F.count_distinct("price").alias("distinct_prices"),
                F.min("price").alias("min_price"),
                F.max("price").alias("max_price"),
                F.sum("price").alias("total_price"))
            .where(F.col("rows") > 1))


def price_consistency_summary(items: DataFrame) -> DataFrame:
    """How many repeated pairs exist and how many of them carry a single price."""
    per_pair = price_consistency(items)
    return per_pair.agg(F.count(F.lit(1)).alias("repeated_pairs"),
                        F.count_if(F.col("distinct_prices") == 1).alias("single_price_pairs"))


# --- D16/D17/D18: quality profile -------------------------------------------------


def nulls(df: DataFrame, table: str) -> DataFrame:
    """NULL count and % per column (one aggregate pass, then unpivot)."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n_{i}") for i, c in enumerate(df.columns)])
    return _unpivot(row, [
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(f"_n_{i}").alias("nulls"), pct(F.col(f"_n_{i}"), F.col("_rows")).alias("pct"))
        for i, c in enumerate(df.columns)])


def columns_info(df: DataFrame, table: str) -> DataFrame:
    """Type and non-NULL count of every column (one aggregate pass)."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_c_{i}") for i, c in enumerate(df.columns)])
    return _unpivot(row, [
        F.struct(F.lit(table).alias("table_name"), F.lit(i).alias("position"),
                 F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
                 F.col(f"_c_{i}").alias("non_null"))
        for i, f in enumerate(df.schema.fields)])


def duplicates(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Rows after the first, for the full row and for the key (NULLs equal)."""
    full = C.group_metric(df, df.columns, lambda c: F.sum(c("_n") - 1))
    by_key = C.group_metric(df, key, lambda c: F.sum(c("_n") - 1))
    row = C.metrics_frame({"full": full, "key": by_key})
    return _unpivot(row, [
        F.struct(F.lit(table).alias("table_name"), F.lit(kind).alias("duplicate_kind"),
                 F.coalesce(F.col(col), F.lit(0)).cast("bigint").alias("duplicate_rows"))
        for kind, col in (("full_row", "full"), ("(" + ", ".join(key) + ")", "key"))])


def anomalies(items: DataFrame) -> DataFrame:
    """Impossible values in the columns the pipeline uses, one aggregate pass."""
    return items.agg(
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("product_id").isNull()).alias("null_product_id"),
        F.count_if(F.col("price").isNull()).alias("null_price"),
        F.count_if(F.col("price") <= 0).alias("price_not_positive"),
        F.count_if(F.col("freight_value") < 0).alias("freight_negative"),
    )


# --- C5-C8, E6: relationships between the two tables -----------------------------


def orders_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Inner join on order_id (one to many): the relevant columns of the result. Hot orders are dealt over tasks."""
    return spread_join(orders.select("order_id", "order_purchase_timestamp", "order_status"),
                       items.select("order_id", "product_id", "order_item_id", "price"), "order_id")


def join_coverage(left: DataFrame, right: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows of a full outer join per side (both / left_only / right_only).

    Both sides are first reduced to (key, rows); the outer join then matches one row
    per key and side (NULL keys equal), and a key with ``a`` left and ``b`` right rows
    contributes ``a * b`` matched rows. No row-level join, no skew.
    """
    lc = left.groupBy(key).agg(F.count(F.lit(1)).alias("a")).withColumnRenamed(key, "lk")
    rc = right.groupBy(key).agg(F.count(F.lit(1)).alias("b")).withColumnRenamed(key, "rk")
    j = lc.join(rc, lc["lk"].eqNullSafe(rc["rk"]), "full")
    side = (F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.lit("both"))
            .when(F.col("a").isNotNull(), F.lit("left_only")).otherwise(F.lit("right_only")))
    rows = F.coalesce(F.col("a"), F.lit(1)) * F.coalesce(F.col("b"), F.lit(1))
    return j.groupBy(side.alias("side")).agg(F.sum(rows).cast("bigint").alias("rows"))


def multi_item_orders(items: DataFrame) -> DataFrame:
    """Items of the orders that have more than one item (semi join)."""
    multi = (items.groupBy("order_id").agg(F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1).select("order_id"))
    return items.join(multi, "order_id", "left_semi")


def orders_without_items_by_status(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with no item (anti join), counted per non-NULL status."""
    lonely = orders.join(items.select("order_id").distinct(), "order_id", "left_anti")
    return (lonely.where(F.col("order_status").isNotNull()).groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("orders")))


def key_set_difference(orders: DataFrame, items: DataFrame, key: str = "order_id") -> DataFrame:
    """Distinct keys in one table and not the other, both directions (set semantics)."""
    # Sets treat NULLs as equal, so NULL becomes a value that no key has.
    orders, items = (df.select(F.coalesce(F.col(key), F.lit("\u0000")).alias(key)) for df in (orders, items))
    rows = C.metrics_frame({
        "items_not_in_orders": C.coverage_metric(items, orders, key, lambda ni, no: F.count_if(
            ni.isNotNull() & no.isNull())),
        "orders_not_in_items": C.coverage_metric(orders, items, key, lambda no, ni: F.count_if(
            no.isNotNull() & ni.isNull())),
    })
    return _unpivot(rows, [
        F.struct(F.lit(d).alias("direction"), F.col(d).cast("bigint").alias("keys"))
        for d in ("items_not_in_orders", "orders_not_in_items")])


# --- E2-E4: previews and top-k (the limit is the feature) --------------------------


def preview(gold: DataFrame, n: int = 10) -> DataFrame:
    return gold.orderBy("purchase_date", "product_id").limit(n)


def top_priced_items(items: DataFrame, n: int = 5) -> DataFrame:
    """The n most expensive items; ties broken by the remaining columns."""
    cols = ["order_id", "order_item_id", "product_id", "price", "freight_value"]
    return items.select(*cols).orderBy(
        F.col("price").desc_nulls_last(), "order_id", "order_item_id", "product_id",
        "freight_value").limit(n)


def top_orders_by_items(orders: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    return order_summary(orders, items).orderBy(F.col("items").desc(), "order_id").limit(n)


def most_repeated_orders(items: DataFrame, n: int = 3) -> DataFrame:
    """Every row of the n orders that repeat a product most, sorted (the limit is the feature)."""
    top = (product_quantities(items).groupBy("order_id").agg(F.max("quantity").alias("_q"))
           .orderBy(F.col("_q").desc(), "order_id").limit(n).select("order_id"))
    return items.join(top, "order_id", "left_semi").orderBy("order_id", "product_id", "order_item_id")


def top_repeated_pairs(items: DataFrame, n: int = 3) -> DataFrame:
    return (product_quantities(items).where(F.col("quantity") > 1)
            .orderBy(F.col("quantity").desc(), "order_id", "product_id").limit(n))
