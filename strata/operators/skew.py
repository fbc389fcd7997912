"""Joins whose many side may hold a large share of its rows under one key.

Adaptive execution splits a large partition of a join after it has been written; this deals a hot key over
partitions before, so it holds without it, and where one key fills a whole partition file.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that a sketch follows for each partition: its counts are off by less than half a partition's share.
TRACKED, MOST_TRACKED = 8, 1_000_000


def hot_keys(df: DataFrame, key: str, parts: int) -> list[tuple[object, int]]:
    """Keys that hold more than one of ``parts`` shares of the rows, each with the number of tasks it is dealt to.

    Counted in one pass by mergeable frequent-item sketches: no shuffle of keys, and at most ``parts`` rows to the driver.
    The counts are estimates; they decide the balance of a join, never its rows.
    """
    tracked = min(MOST_TRACKED, TRACKED * parts)
    top = F.call_function("approx_top_k", F.col(key), F.lit(min(parts, tracked)), F.lit(tracked))
    row = df.agg(F.count(key).alias("n"), top.alias("top")).first()
    return [(x["item"], math.ceil(x["count"] * parts / row["n"])) for x in row["top"] or () if x["count"] * parts > row["n"]]


def spread_join(one: DataFrame, many: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Inner join on ``key`` (null keys match nothing): a hot key's rows of ``many`` are dealt by their content over as many
    tasks as they make shares, and its rows of ``one`` are repeated there.

    Fewer than ``parts`` keys can be hot, and their tasks add up to at most twice ``parts``: that bounds what is
    broadcast and what is repeated for each row of ``one``. Rows of ``many`` equal in every column stay together.
    """
    spark = many.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(many, key, parts)
    if not hot:
        return one.join(many, key)
    kind = many.schema[key].dataType.simpleString()
    shares = F.broadcast(spark.createDataFrame(hot, f"{key} {kind}, _shares int"))
    shared = F.coalesce("_shares", F.lit(1))
    dealt = many.join(shares, key, "left").withColumn(
        "_share", F.pmod(F.xxhash64(*many.columns), shared.cast("long"))).drop("_shares")
    repeated = one.join(shares, key, "left").withColumn(
        "_share", F.explode(F.sequence(F.lit(0).cast("long"), shared.cast("long") - 1))).drop("_shares")
    return repeated.join(dealt, [key, "_share"]).drop("_share")
