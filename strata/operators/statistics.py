"""Mergeable statistics of published parts, kept in the pointer of the version that names them.

A part is never changed, so what was measured on it once stays true, and the next version that names it again need not
read it. Of each part: rows and totals, split by the values of one column where a rule chooses among them, and
exact distinct counts of keys. Rows and totals of parts add up; a distinct count adds up where the parts are cut by a
column of its key (no key lies in two parts). Any other is measured on the whole version when it is published, or, where
nothing was kept, on the table when it is asked for.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A split by more values than this is not kept in a pointer; readers then measure the table.
VALUES = 1_000


@dataclass(frozen=True)
class Shape:
    """What is measured: totals of columns, the column that splits them, keys counted, the column that cuts parts."""

    totals: tuple[str, ...] = ()
    split: str | None = None
    keys: tuple[tuple[str, ...], ...] = ()
    cut: str | None = None

    def additive(self, key: tuple[str, ...]) -> bool:
        return self.cut is not None and self.cut in key


def _name(key: Sequence[str]) -> str:
    return ",".join(key)


def _distinct(key: Sequence[str]) -> Column:
    """Nulls count as values, as in a grouping."""
    return F.count_distinct(F.struct(*key)).alias(_name(key))


def measure_parts(df: DataFrame, shape: Shape, part: Column | None = None) -> dict[str, dict] | None:
    """Statistics by part name (one unnamed part without ``part``); None if the split has too many values.

    Two aggregations over the columns needed; the driver sees a row for each part and value of the split.
    """
    part = F.lit("") if part is None else part
    value = F.col(shape.split).cast("string") if shape.split else F.lit(None).cast("string")
    rows = (df.groupBy(part.alias("part"), value.alias("value"))
            .agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).cast("string").alias(f"t{k}") for k, c in enumerate(shape.totals)]))
    groups = rows.limit(VALUES + 1).collect() if shape.split else rows.collect()
    if shape.split and len(groups) > VALUES:
        return None
    found: dict[str, dict] = {}
    for r in groups:
        found.setdefault(r["part"], {"groups": [], "distinct": {}})["groups"].append(
            [r["value"], r["rows"], {c: r[f"t{k}"] for k, c in enumerate(shape.totals)}])
    own = [k for k in shape.keys if shape.cut is None or shape.additive(k)]
    for key in own:  # one at a time: several distinct counts at once would multiply the rows
        for r in df.groupBy(part.alias("part")).agg(_distinct(key).alias("n")).collect():
            found[r["part"]]["distinct"][_name(key)] = r["n"]
    return found


def without(shape: Shape, surplus: dict[tuple[str, ...], int]) -> Shape:
    """The shape less the keys whose surplus is known: what is left to measure."""
    return replace(shape, keys=tuple(k for k in shape.keys if k not in surplus))


def add_counted(parts: dict[str, dict] | None, surplus: dict[tuple[str, ...], int]) -> dict[str, dict] | None:
    """Distinct counts from ``surplus`` (rows beyond the first of their key, where a check has counted them on these rows).

    They are a part's rows less its surplus: that of the one part, or none in any part.
    """
    for key, extra in surplus.items():
        if extra and len(parts or {}) > 1:
            raise ValueError(f"a surplus of {_name(key)} over several parts belongs to none of them")
        for kept in (parts or {}).values():
            kept["distinct"][_name(key)] = sum(g[1] for g in kept["groups"]) - extra
    return parts


def measure_whole(df: DataFrame, shape: Shape) -> dict[str, int]:
    """Distinct counts that do not add up over parts."""
    return {_name(k): df.agg(_distinct(k)).first()[0] for k in shape.keys if shape.cut and not shape.additive(k)}


class Statistics:
    """Merged statistics of a version's parts. A value that cannot be had from them is None."""

    def __init__(self, shape: Shape, parts: Sequence[dict], whole: dict[str, int] | None = None):
        self.shape, self.parts, self.whole = shape, list(parts), whole or {}

    @classmethod
    def of(cls, shape: Shape, facts: dict, names: Sequence[str]) -> "Statistics | None":
        """From a pointer's facts; None unless every part the version names was measured by this shape."""
        kept = facts.get("statistics")
        if not kept or kept.get("shape") != said(shape) or any(n not in kept["parts"] for n in names):
            return None
        return cls(shape, [kept["parts"][n] for n in names], kept.get("whole"))

    def _groups(self, among: Sequence[str] | None):
        return (g for p in self.parts for g in p["groups"] if among is None or (g[0] is not None and g[0] in among))

    def rows(self, among: Sequence[str] | None = None) -> int:
        return sum(g[1] for g in self._groups(among))

    def total(self, column: str, among: Sequence[str] | None = None) -> Decimal | None:
        if column not in self.shape.totals:
            return None
        return sum((Decimal(g[2][column]) for g in self._groups(among) if g[2][column] is not None), Decimal(0))

    def distinct(self, key: Sequence[str]) -> int | None:
        name = _name(key)
        if name in self.whole:
            return self.whole[name]
        if tuple(key) not in self.shape.keys or not (len(self.parts) <= 1 or self.shape.additive(tuple(key))):
            return None
        counts = [p["distinct"].get(name) for p in self.parts]
        return None if None in counts else sum(counts)


def said(shape: Shape) -> list:
    """The shape as the pointer stores it: statistics of another shape are measured anew."""
    return [list(shape.totals), shape.split, [list(k) for k in shape.keys], shape.cut]


def facts(shape: Shape, parts: dict[str, dict], whole: dict[str, int] | None = None) -> dict:
    return {"statistics": {"shape": said(shape), "parts": parts, "whole": whole or {}}}
