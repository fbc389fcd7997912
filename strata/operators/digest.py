"""Order-free content digests: what a table holds, as a few numbers that merge.

A row is one text, in which every value stands with its column's name and length (so no
two different rows read alike, columns may come in any order, and NULL is not the empty text). Its
MD5 gives two 60-bit numbers. A digest is the number of rows, their characters, and the sum and the
xor of both numbers: repeated rows count, order does not, and the digests of splits, files or
partitions add up to the digest of the whole. Nothing is held or sorted, so a table of any size
is one map-side aggregation, and two tables are compared without meeting.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEASURES = ("rows", "characters", "sum1", "sum2", "xor1", "xor2")
#: Hex digits of each of the two numbers: 60 bits, so that they are positive longs in any engine.
DIGITS = 15


def canonical(columns: Sequence[str]) -> Column:
    """A row as one text: ``name=length:value`` by name, ``name-`` for NULL."""
    parts = []
    for name in sorted(columns):
        value = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.lit(f"{name}="), F.length(value).cast("string"), F.lit(":"), value),
                                F.lit(f"{name}-")))
    return F.concat(*parts) if parts else F.lit("")


def characters(columns: Sequence[str]) -> Column:
    """Characters of a row's values; NULL has none."""
    total = F.lit(0)
    for name in columns:
        total = total + F.coalesce(F.length(F.col(f"`{name}`").cast("string")), F.lit(0))
    return total


def _number(hexed: Column, begin: int) -> Column:
    return F.conv(F.substring(hexed, begin, DIGITS), 16, 10).cast("bigint")


def measures(text: Column, size: Column) -> list[Column]:
    """The aggregates of a digest over rows given as texts; an empty table has zeros."""
    hexed = F.md5(text.cast("binary"))
    first, second = _number(hexed, 1), _number(hexed, DIGITS + 1)
    zero = lambda c, kind: F.coalesce(c, F.lit(0)).cast(kind)
    return [F.count(F.lit(1)).alias("rows"), zero(F.sum(size), "bigint").alias("characters"),
            zero(F.sum(first.cast("decimal(20,0)")), "decimal(38,0)").alias("sum1"),
            zero(F.sum(second.cast("decimal(20,0)")), "decimal(38,0)").alias("sum2"),
            zero(F.bit_xor(first), "bigint").alias("xor1"), zero(F.bit_xor(second), "bigint").alias("xor2")]


def digest(df: DataFrame, keys: Sequence[str | Column] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One digest for each key, or one row for the whole table."""
    columns = list(columns or df.columns)
    return df.groupBy(*keys).agg(*measures(canonical(columns), characters(columns)))


def merge(digests: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Digests of parts as the digest of their union."""
    return digests.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("rows", "characters")],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)").alias(c) for c in ("sum1", "sum2")],
        *[F.coalesce(F.bit_xor(c), F.lit(0)).alias(c) for c in ("xor1", "xor2")])
