"""Cross-layer reconciliation: layers declare what can be measured on them, relations say what must hold between.

A *measure* is a number of one table (``silver.sales.units``), an aggregate over its rows or its keys. A *relation*
names two measures, how they must stand to each other, and how far apart they may be; checks, their names
and messages follow from it, so another relation is another line. All measures a set of relations needs come from
one fused evaluation (one aggregate pass a table, one grouped pass a key), never one action a number; measures of
published tables are had from the statistics kept with their parts, where there are any (``statistics.py``).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from strata.functions.convert import pct
from strata.operators import checks as C
from strata.operators import gold as G
from strata.operators.statistics import Shape, Statistics
from strata.sources.schemas import DEFAULT_VALID_SALE_STATUSES

SILVER_ONLY = "silver"
THROUGH_GOLD = "gold"
LAYERS = ("bronze", SILVER_ONLY, THROUGH_GOLD)


@dataclass
class LayerFrames:
    bronze_orders: DataFrame
    bronze_items: DataFrame
    orders: DataFrame
    items: DataFrame
    sales: DataFrame
    gold: DataFrame | None = None


@dataclass(frozen=True)
class Measure:
    """One number of a table: how it is measured on rows, and how it is had from kept statistics."""

    made: Callable[[DataFrame, Column], C.Metric]
    kept: Callable[[Statistics, Sequence[str]], object]
    total: str | None = None
    key: tuple[str, ...] = ()
    sold: bool = False


def _total(column: str) -> Measure:
    return Measure(lambda df, sold: C.sum_metric(df, column), lambda s, valid: s.total(column), total=column)


def _sold(column: str) -> Measure:
    """The same sum over valid sales only, in the same pass."""
    return Measure(lambda df, sold: C.rows_metric(df, F.coalesce(F.sum(F.when(sold, F.col(column))), F.lit(0))),
                   lambda s, valid: s.total(column, valid), total=column, sold=True)


def _distinct(*keys: str) -> Measure:
    return Measure(lambda df, sold: C.distinct_count(df, list(keys)), lambda s, valid: s.distinct(keys), key=keys)


ROWS = Measure(lambda df, sold: C.row_count(df), lambda s, valid: s.rows())
SOLD_ROWS = Measure(lambda df, sold: C.rows_metric(df, F.count_if(sold)), lambda s, valid: s.rows(valid), sold=True)


@dataclass(frozen=True)
class Table:
    """A table of a layer: which frame it is, what results call it, its measures, and the column that cuts its parts."""

    frame: str
    called: str
    measures: dict[str, Measure]
    cut: str | None = None

    @property
    def shape(self) -> Shape:
        """Statistics that hold every measure."""
        ms = self.measures.values()
        return Shape(tuple(dict.fromkeys(m.total for m in ms if m.total)),
                     "order_status" if any(m.sold for m in ms) else None,
                     tuple(dict.fromkeys(m.key for m in ms if m.key)), self.cut)


TABLES = {
    "bronze.orders": Table("bronze_orders", "orders", {"rows": ROWS}),
    "bronze.items": Table("bronze_items", "order_items", {"rows": ROWS}),
    "silver.orders": Table("orders", "orders", {"rows": ROWS}),
    "silver.items": Table("items", "order_items", {"rows": ROWS}),
    "silver.sales": Table("sales", "order_product_sales", {
        "rows": ROWS, "keys": _distinct("order_id", "product_id"), "units": _total("quantity"),
        "sold_rows": SOLD_ROWS, "sold_units": _sold("quantity"), "sold_revenue": _sold("item_revenue")}),
    "gold.daily": Table("gold", "daily_product_sales", {
        "rows": ROWS, "keys": _distinct("purchase_date", "product_id"), "units": _total("quantity"),
        "revenue": _total("total_revenue"), "products": _distinct("product_id"), "days": _distinct("purchase_date")},
        cut="purchase_date"),
}
MONEY = "revenue"


@dataclass(frozen=True)
class Relation:
    """``left`` stands to ``right`` as ``how`` says: equal, close (within ``tolerance``) or at_most."""

    left: str
    how: str
    right: str
    tolerance: Decimal = Decimal(0)

    @property
    def name(self) -> str:
        return f"{self.left}_{self.how}_{self.right}".replace(".", "_")

    @property
    def depth(self) -> int:
        """Place of the last layer that it needs."""
        return max(LAYERS.index(m.split(".")[0]) for m in (self.left, self.right))

    def check(self, measured: "LayerMetrics") -> C.Check:
        table = TABLES[self.left.rsplit(".", 1)[0]].called
        a, b = measured[self.left], measured[self.right]
        if self.how == "equal":
            return C.expected_count(self.name, table, a, b)
        if self.how == "close":
            return C.within_tolerance(self.name, table, a, b, self.tolerance)
        if self.how == "at_most":
            return C.not_greater(self.name, table, a, b)
        raise ValueError(f"unknown relation {self.how!r}")


RELATIONS = (
    Relation("silver.orders.rows", "equal", "bronze.orders.rows"),
    Relation("silver.items.rows", "equal", "bronze.items.rows"),
    Relation("silver.sales.units", "equal", "silver.items.rows"),
    Relation("silver.sales.rows", "equal", "silver.sales.keys"),
    Relation("gold.daily.rows", "equal", "gold.daily.keys"),
    Relation("gold.daily.units", "equal", "silver.sales.sold_units"),
    Relation("gold.daily.revenue", "close", "silver.sales.sold_revenue", Decimal("0.01")),
    Relation("gold.daily.units", "at_most", "silver.sales.units"),
)


class LayerMetrics:
    """Every measure of the given layers, as Metric objects that checks and reports share."""

    def __init__(self, f: LayerFrames,
                 valid_sale_statuses: Sequence[str] = DEFAULT_VALID_SALE_STATUSES,
                 statistics: dict[str, Statistics] | None = None):
        """``statistics`` by table name: measures had from them are constants; all others are measured on the rows."""
        sold, valid, kept = G.is_valid_sale(valid_sale_statuses), list(valid_sale_statuses), statistics or {}
        self.named = {}
        for name, t in TABLES.items():
            df = getattr(f, t.frame)
            for measure, m in t.measures.items() if df is not None else ():
                value = m.kept(kept[name], valid) if name in kept else None
                self.named[f"{name}.{measure}"] = m.made(df, sold) if value is None else C.literal(
                    value if measure.endswith(MONEY) else int(value))

    @classmethod
    def from_values(cls, values: dict) -> "LayerMetrics":
        """Measures already computed (a row of ``frame``), as constants for the checks."""
        m = cls.__new__(cls)
        m.named = {f"{name}.{measure}": C.literal(values[_column(f"{name}.{measure}")])
                   for name, t in TABLES.items() for measure in t.measures if _column(f"{name}.{measure}") in values}
        return m

    def __getitem__(self, name: str) -> C.Metric:
        if name not in self.named:
            raise ValueError(f"{name} needs a layer that was not given")
        return self.named[name]

    def frame(self) -> DataFrame:
        """One row with every measure; money as decimal(38,2), counts as bigint."""
        wide = C.metrics_frame({_column(name): m for name, m in self.named.items()})
        return wide.select(*[F.col(_column(name)).cast(DecimalType(38, 2) if name.endswith(MONEY) else "bigint")
                             .alias(_column(name)) for name in self.named])


def _column(name: str) -> str:
    return name.replace(".", "_")


def layer_checks(m: LayerMetrics, upto: str = THROUGH_GOLD, relations: Sequence[Relation] = RELATIONS) -> list[C.Check]:
    """Checks of the relations between layers as far as ``upto``."""
    return [r.check(m) for r in relations if r.depth <= LAYERS.index(upto)]


def layer_summary(metrics_row: DataFrame) -> DataFrame:
    """One row per (layer, table): rows, units, revenue, days, products, discarded units.

    ``metrics_row`` is ``LayerMetrics.frame()`` (one row), so this is a projection.
    """
    shown = {  # what a layer's row shows, by the measure it comes from
        "bronze.orders": {}, "bronze.items": {}, "silver.orders": {}, "silver.items": {"units": "rows"},
        "silver.sales": {"units": "units", "revenue": "sold_revenue"},
        "gold.daily": {k: k for k in ("units", "revenue", "days", "products")}}
    rows = []
    for name, from_ in shown.items():
        if _column(f"{name}.rows") not in metrics_row.columns:
            continue
        at = lambda m: F.col(_column(f"{name}.{m}"))  # noqa: E731, B023
        lost = F.col("silver_sales_units") - at("units") if name == "gold.daily" else F.lit(None)
        share = pct(lost, F.col("silver_sales_units")) if name == "gold.daily" else F.lit(None)
        value = lambda m: at(from_[m]) if m in from_ else F.lit(None)  # noqa: E731, B023
        rows.append(F.struct(
            F.lit(name.split(".")[0]).alias("layer"), F.lit(TABLES[name].called).alias("table_name"),
            at("rows").cast("bigint").alias("rows"), value("units").cast("bigint").alias("units"),
            value("revenue").cast(DecimalType(38, 2)).alias("revenue"), value("days").cast("bigint").alias("days"),
            value("products").cast("bigint").alias("products"), lost.cast("bigint").alias("discarded_units"),
            share.cast("double").alias("discarded_pct")))
    return metrics_row.select(F.inline(F.array(*rows)))
