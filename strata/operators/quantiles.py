"""Exact percentiles with linear interpolation, by counting slices and cutting them finer.

``percentile`` (exact) keeps every distinct value of a group in one aggregation buffer and merges them in one
final task, which does not survive a 100 TB column. Here no value is ever gathered. A rank is
selected in rounds over several columns at once:

1. one aggregate gives each column's number of values, least and greatest: the first interval;
2. a round cuts each open interval into slices and counts rows, least and greatest value per slice. Counting is
   map-side, so a task sends one row for each slice it meets, whatever the data hold;
3. the slice that holds a wanted rank is the next interval, between the values it really has;
4. until the interval is one value: that is the value at the rank.

A slice is a monotone function of the value: the sum of an even cut, of one by the sixteenth root of the
distance from the interval's least value and of one by that root of the distance from zero, so a far outlier
or many orders of magnitude cost a round or two more, not many. An interval's ends are slices of
their own, so every round leaves fewer values and the rounds end. The driver sees at most ``slices + 2``
rows for each wanted rank in a round; the intervals reach the pass as a table of as many rows
at most, so that its code is the same in all rounds.

Result: the same numbers as pandas/numpy ``quantile`` (linear) and DuckDB ``quantile_cont``. NULL
and NaN are ignored; a column without values yields no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slices of an interval, and the fewest: fewer would only add rounds.
SLICES, FEWEST = 4096, 256


@dataclass(frozen=True)
class Interval:
    """Rows of one column from rank ``start`` on, between two values that occur."""

    column: int
    start: int
    rows: int
    least: float
    greatest: float

    def holds(self, rank: int) -> bool:
        return self.start <= rank < self.start + self.rows


def _sliced(rows: DataFrame, slices: int) -> DataFrame:
    """``rows`` (v, least, greatest) with the slice of v within its interval, never falling as v rises.

    Steps are columns of their own, used more than once each: the generated code stays small enough to be compiled.
    """
    even, root = max(1, slices // 2), max(1, slices // 4)
    v, least, greatest = F.col("v"), F.col("least"), F.col("greatest")
    # Halved first: the difference of two doubles may be beyond any double. No width or no number counts as 0.
    share = (v / 2 - least / 2) / F.nullif(greatest / 2 - least / 2, F.lit(0.0))
    size = F.abs(v) / F.nullif(F.greatest(F.abs(least), F.abs(greatest)), F.lit(0.0))
    clean = lambda c: F.when((c >= 0) & (c <= 1), c).otherwise(F.lit(0.0))
    place = lambda x, n: F.least(F.floor(x * n), F.lit(n - 1))
    steps = rows.withColumns({"share": share, "size": size}).withColumns({"share": clean(F.col("share")), "size": clean(F.col("size"))})
    signed = (F.signum(v) * F.pow("size", F.lit(1 / 16)) + 1) / 2
    inner = 1 + place(F.col("share"), even) + place(F.pow("share", F.lit(1 / 16)), root) + place(signed, root)
    return steps.withColumn("slice", F.when(v == least, F.lit(0)).when(v == greatest, F.lit(even + 2 * root))
                            .otherwise(inner).cast("int"))


def _value(df: DataFrame, column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def first_intervals(df: DataFrame, columns: Sequence[str]) -> list[Interval]:
    """Each column that has values, whole."""
    aggregates = []
    for i, c in enumerate(columns):
        v = _value(df, c)
        aggregates += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    row = df.agg(*aggregates).first()
    return [Interval(i, 0, row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i in range(len(columns)) if row[f"n{i}"]]


def counted_slices(df: DataFrame, columns: Sequence[str], open_: Sequence[Interval], slices: int) -> DataFrame:
    """interval (its place in ``open_``), slice, rows, least, greatest: one narrow pass and a map-side count.

    The open intervals, at most one for each wanted rank, are broadcast; a value lies in one of them or in none.
    """
    values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), _value(df, c).alias("v"))
                                           for i, c in enumerate(columns)])).alias("e")).select("e.*").filter("v is not null")
    listed = ", ".join(f"({x.column}, {k}, double('{x.least!r}'), double('{x.greatest!r}'))" for k, x in enumerate(open_))
    known = df.sparkSession.sql(f"SELECT * FROM VALUES {listed} AS t(of, interval, least, greatest)")
    inside = (F.col("i") == F.col("of")) & (F.col("v") >= F.col("least")) & (F.col("v") <= F.col("greatest"))
    rows = _sliced(values.join(F.broadcast(known), inside), slices)
    return rows.groupBy("interval", "slice").agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("least"), F.max("v").alias("greatest"))


def select_ranks(df: DataFrame, columns: Sequence[str], wanted: dict[int, set[int]], whole: Sequence[Interval],
                 slices: int = SLICES) -> dict[tuple[int, int], float]:
    """The value at each wanted rank (from 0, by column number) in order of value."""
    at = {(x.column, rank): x for x in whole for rank in wanted.get(x.column, ())}
    while True:
        open_ = sorted({x for x in at.values() if x.least < x.greatest}, key=lambda x: (x.column, x.start))
        if not open_:
            return {key: x.least for key, x in at.items()}
        parts: dict[Interval, list[Interval]] = {x: [] for x in open_}
        for r in sorted(counted_slices(df, columns, open_, slices).collect(), key=lambda r: (r["interval"], r["slice"])):
            of = open_[r["interval"]]
            start = parts[of][-1].start + parts[of][-1].rows if parts[of] else of.start
            parts[of].append(Interval(of.column, start, r["rows"], r["least"], r["greatest"]))
        for key, x in at.items():
            if x in parts:
                at[key] = next(y for y in parts[x] if y.holds(key[1]))


def column_percentiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                       slices: int | None = None) -> DataFrame:
    """One row per (column, probability): ``column_name``, ``p``, ``value`` (double)."""
    probs = [float(p) for p in probs]
    if not probs or any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must be in [0, 1]")
    if not columns:
        raise ValueError("no columns")
    whole = first_intervals(df, columns)
    place = {(x.column, p): p * (x.rows - 1) for x in whole for p in probs}
    wanted: dict[int, set[int]] = {}
    for (i, _), at in place.items():
        wanted.setdefault(i, set()).update((math.floor(at), math.ceil(at)))
    found = select_ranks(df, columns, wanted, whole, max(slices or SLICES, FEWEST))
    rows = []
    for (i, p), at in place.items():
        low, high = found[i, math.floor(at)], found[i, math.ceil(at)]
        rows.append((columns[i], p, low if low == high else low + (high - low) * (at - math.floor(at))))
    return df.sparkSession.createDataFrame(rows, "column_name string, p double, value double")


def exact_percentiles(df: DataFrame, column: str, probs: Sequence[float],
                      slices: int | None = None) -> DataFrame:
    """One row per probability: ``p`` (double), ``value`` (double)."""
    return column_percentiles(df, [column], probs, slices).select("p", "value")
