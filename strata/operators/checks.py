"""Data-quality checks, evaluated in as few passes as possible.

A check never triggers its own Spark action. Each one declares the aggregates it needs
(*measures*) over some frame, and :class:`Evaluator` plans all measures of a suite
together:

- every row-level measure over one frame is one ``agg`` (ten checks on a table = one
  scan, no shuffle);
- every grouped measure over one frame is one aggregation: a ``groupBy`` for one key
  set, a ``groupingSets`` aggregate for several (one scan, one shuffle, map-side
  partial aggregation, so a hot key is pre-aggregated before it moves);
- measures that compare the keys of two frames (referential integrity, keys without
  match) share one aggregation of both sides' keys, counted per side;
- the one-row partial results are stacked with ``unionByName`` and folded into one
  wide row with a global ``max``: no join of any kind between them.

The results frame has one row per check, in the given order.

Counting rules (they matter, tests pin each one):

- not null: rows where the column is NULL.
- unique: total rows minus distinct keys (three copies count 2; NULL keys are equal).
- non-negative: rows ``< 0``; NULL passes.
- greater than: rows ``<= minimum`` or NULL.
- referential integrity: child *rows* whose key has no parent (a NULL key counts).
- constant in group: *groups* with more than one distinct non-NULL value.
- date range: non-NULL rows outside the inclusive period; min/max of those rows in
  ``details`` only when there are any.
- keys without match: distinct left *keys* missing on the right.
- expected count: ``abs(actual - expected)``.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, LongType, MapType, StringType, StructField, StructType, TimestampType,
)

CRITICAL = "CRITICAL"
WARNING = "WARNING"
OK = "OK"
FAIL = "FAIL"

RESULT_SCHEMA = StructType([
    StructField("check", StringType(), False),
    StructField("table_name", StringType(), False),
    StructField("severity", StringType(), False),
    StructField("result", StringType(), False),
    StructField("affected_rows", LongType(), True),
    StructField("message", StringType(), True),
    StructField("details", MapType(StringType(), StringType()), True),
])


def _empty_details() -> Column:
    return F.create_map().cast(MapType(StringType(), StringType()))


class DataQualityError(Exception):
    """At least one CRITICAL check failed. Carries every result of the evaluation."""

    def __init__(self, message: str, results: list):
        super().__init__(message)
        self.results = results


# --- measures -------------------------------------------------------------


@dataclass(frozen=True, eq=False)
class Metric:
    """A scalar that a check or report needs.

    ``rows``: aggregate ``expr`` over the rows of ``df``. ``groups``: aggregate over
    ``df.groupBy(keys)``, whose per-group columns are ``_n`` (row count), the key
    columns and ``inner``; ``fn(col)`` builds that aggregate from a column resolver
    and must only use aggregates that skip NULL input (sum, count(col), count_if,
    min, max), because several key sets share one aggregation and each sees the
    others' rows as NULL. ``coverage``: aggregate ``fn(n_a, n_b)`` over the per-key
    row counts of two frames matched on one key (see ``coverage_metric``). ``frame``:
    aggregate over a derived frame owned by one check. ``literal``: a driver-side
    constant.
    """

    kind: str
    df: DataFrame | None = None
    expr: Column | None = None
    keys: tuple = ()
    inner: tuple = ()
    value: object = None
    fn: Callable | None = None

    def resolve(self, ev: "Evaluator") -> Column:
        return ev.add(self)


def rows_metric(df: DataFrame, expr: Column) -> Metric:
    return Metric("rows", df=df, expr=expr)


def row_count(df: DataFrame) -> Metric:
    return Metric("rows", df=df, expr=F.count(F.lit(1)))


def sum_metric(df: DataFrame, column: str) -> Metric:
    """Sum that is 0, not NULL, over an empty frame."""
    return Metric("rows", df=df, expr=F.coalesce(F.sum(column), F.lit(0)))


def distinct_count(df: DataFrame, keys: Sequence[str]) -> Metric:
    """Number of distinct key tuples, NULL counted as a value (like ``distinct().count()``)."""
    return group_metric(df, keys, lambda c: F.count(c("_n")))


def group_metric(df: DataFrame, keys: Sequence[str], fn: Callable[[Callable[[str], Column]], Column],
                 inner: Sequence[tuple[str, Column]] = ()) -> Metric:
    """Aggregate over the groups of ``df`` by ``keys``; ``fn(col)`` sees ``_n``, keys, ``inner``."""
    return Metric("groups", df=df, keys=tuple(keys), fn=fn, inner=tuple(inner))


def coverage_metric(a: DataFrame, b: DataFrame, key: str,
                    fn: Callable[[Column, Column], Column]) -> Metric:
    """Aggregate over the per-key row counts of two frames, matched on ``key``.

    ``fn(n_a, n_b)`` receives the row counts of ``a`` and ``b`` per key (NULL where the
    key is absent on that side; NULL keys never match). Every coverage metric over the
    same pair and key, in either direction, shares one full outer join of the two
    pre-aggregated sides.
    """
    return Metric("coverage", df=a, keys=(key,), value=b, fn=fn)


def frame_metric(df: DataFrame, expr: Column) -> Metric:
    return Metric("frame", df=df, expr=expr)


def literal(value) -> Metric:
    return Metric("literal", value=value)


def _as_metric(x) -> Metric:
    return x if isinstance(x, Metric) else literal(x)


class Evaluator:
    """Collects measures and computes all of them as one wide row."""

    def __init__(self):
        self._sources: dict[tuple, dict] = {}
        self._n = 0

    def _alias(self) -> str:
        self._n += 1
        return f"m{self._n}"

    def _source(self, key: tuple, kind: str, df: DataFrame, keys: tuple = ()) -> dict:
        src = self._sources.get(key)
        if src is None:
            src = {"kind": kind, "df": df, "keys": keys, "inner": {}, "outer": []}
            self._sources[key] = src
        return src

    def add(self, m: Metric) -> Column:
        if m.kind == "literal":
            return F.lit(m.value)
        if m.kind == "rows":
            src = self._source(("rows", id(m.df)), "rows", m.df)
        elif m.kind == "groups":
            # A key set is a set: (a, b) and (b, a) are one grouping, never two.
            src = self._source(("groups", id(m.df), tuple(sorted(m.keys))), "groups", m.df, m.keys)
            for name, expr in m.inner:
                src["inner"].setdefault(name, expr)
        elif m.kind == "frame":
            src = self._source(("frame", id(m.df)), "frame", m.df)
        elif m.kind == "coverage":
            a, b, key = m.df, m.value, m.keys[0]
            pair = tuple(sorted((id(a), id(b))))
            src = self._source(("coverage", pair, key), "coverage", a, (key,))
            src.setdefault("frames", {id(a): a, id(b): b})
            first = pair[0]
            fn = m.fn
            swapped = id(a) != first

            def oriented(na, nb, fn=fn, swapped=swapped):
                return fn(nb, na) if swapped else fn(na, nb)
            alias = self._alias()
            src["outer"].append((alias, oriented))
            return F.col(alias)
        else:
            raise ValueError(m.kind)
        alias = self._alias()
        src["outer"].append((alias, m.fn if m.kind == "groups" else m.expr))
        return F.col(alias)

    @staticmethod
    def _coverage_part(src: dict) -> DataFrame:
        """Rows of both frames per key, counted side by side in one map-side combined aggregation.

        The two key columns are stacked with their side and grouped once: one shuffle
        of pre-aggregated keys and no join. NULL keys of the two sides do not match,
        so each side's are a group of their own.
        """
        key = src["keys"][0]
        frames = sorted(src["frames"].items())
        (_, a), (_, b) = frames if len(frames) == 2 else frames * 2
        one, none = F.lit(1).cast("bigint"), F.lit(None).cast("bigint")
        sides = [df.select(F.col(key).alias("_k"), F.when(F.col(key).isNull(), side).alias("_s"),
                           (one if side == 0 else none).alias("_a"), (one if side == 1 else none).alias("_b"))
                 for side, df in ((0, a), (1, b))]
        counted = sides[0].unionByName(sides[1]).groupBy("_k", "_s").agg(
            F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))
        return counted.agg(*[fn(F.col("_na"), F.col("_nb")).alias(a_) for a_, fn in src["outer"]])

    @staticmethod
    def _grouped_part(srcs: list[dict]) -> DataFrame:
        """Every key set over one frame in a single aggregation, read in a single pass.

        One key set is a plain ``groupBy``. Several are one ``groupingSets`` aggregate
        (one scan, one shuffle, map-side combine per key set), consumed by one ``agg``
        in which each key set's measures see only their own rows: every column they
        read is masked with ``when(grouping_id == g, ...)``.
        """
        df = srcs[0]["df"]
        inner = {"_n": F.count(F.lit(1))}
        for s in srcs:
            for name, expr in s["inner"].items():
                inner.setdefault(name, expr)
        inner_cols = [expr.alias(name) for name, expr in inner.items()]
        if len(srcs) == 1:
            grouped = df.groupBy(*srcs[0]["keys"]).agg(*inner_cols)
            return grouped.agg(*[fn(F.col).alias(a) for a, fn in srcs[0]["outer"]])
        cols = list(dict.fromkeys(c for s in srcs for c in s["keys"]))
        grouped = df.groupingSets([list(s["keys"]) for s in srcs], *cols).agg(
            *inner_cols, F.grouping_id().alias("_gid"))
        outer = []
        for s in srcs:
            # grouping_id: bit set (first column most significant) where a column is absent.
            gid = sum(1 << (len(cols) - 1 - j) for j, c in enumerate(cols) if c not in s["keys"])

            def masked(name, gid=gid):
                return F.when(F.col("_gid") == gid, F.col(name))
            outer += [fn(masked).alias(a) for a, fn in s["outer"]]
        return grouped.agg(*outer)

    def wide(self) -> DataFrame:
        """One row, one column per measure. Empty sources still give one row."""
        parts = []
        grouped: dict[int, list[dict]] = {}
        for src in self._sources.values():
            if src["kind"] == "groups":
                grouped.setdefault(id(src["df"]), []).append(src)
            elif src["kind"] == "coverage":
                parts.append(self._coverage_part(src))
            else:
                parts.append(src["df"].agg(*[expr.alias(a) for a, expr in src["outer"]]))
        for srcs in grouped.values():
            parts.append(self._grouped_part(srcs))
        if not parts:
            # Only constants: a single empty row to project them on.
            return SparkSession.getActiveSession().range(1).select()
        if len(parts) == 1:
            return parts[0]
        stacked = parts[0]
        for p in parts[1:]:
            stacked = stacked.unionByName(p, allowMissingColumns=True)
        # Each column is non-NULL in exactly one stacked row: max() folds them.
        return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


class _Recorder(Evaluator):
    """Notes the row measures of one frame instead of planning them."""

    def __init__(self, df: DataFrame):
        super().__init__()
        self.df, self.found = df, []

    def add(self, m: Metric) -> Column:
        if m.kind == "rows" and m.df is self.df:
            self.found.append(m.expr)
            return F.lit(None)
        return super().add(m)


class _Measured(Evaluator):
    """Takes the row measures of one frame from values already known, in the order a recorder notes them."""

    def __init__(self, df: DataFrame, values: Sequence):
        super().__init__()
        self.df, self.values = df, iter(values)

    def add(self, m: Metric) -> Column:
        if m.kind == "rows" and m.df is self.df:
            return _constant(next(self.values))
        return super().add(m)


def _constant(value) -> Column:
    """A measured value as a column; wall-clock times stay as written, whatever the session's zone."""
    if isinstance(value, datetime):
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    return F.lit(value)


def row_measures(checks: Sequence["Check"], df: DataFrame) -> list[Column]:
    """The aggregates over the rows of ``df`` that the checks ask for: what an observation of a write can measure."""
    recorder = _Recorder(df)
    for c in checks:
        c.plan(recorder)
    return recorder.found


def metrics_frame(named: dict[str, Metric]) -> DataFrame:
    """Named metrics as one row, computed with the same fusion as checks."""
    ev = Evaluator()
    cols = {name: ev.add(m) for name, m in named.items()}
    return ev.wide().select(*[c.alias(name) for name, c in cols.items()])


# --- checks ---------------------------------------------------------------


@dataclass
class Outcome:
    affected: Column
    ok: Column
    message: Column
    details: Column = field(default_factory=lambda: _empty_details())


@dataclass
class Check:
    name: str
    table: str
    severity: str
    plan: Callable[[Evaluator], Outcome]

    def with_severity(self, severity: str) -> "Check":
        return Check(self.name, self.table, severity, self.plan)


def describe(kind: str, params: dict | None = None, **values: Column) -> Column:
    """The one message template: ``kind(param=..., ...) value=... value=...``; text a person and a parser can read."""
    head = kind + ("(" + ", ".join(f"{k}={v}" for k, v in params.items()) + ")" if params else "")
    parts = [F.lit(head)]
    for name, value in values.items():
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(value.cast("string"), F.lit("null"))))
    return F.concat_ws(" ", *parts)


def _zero(affected: Column, kind: str, params: dict, **values: Column) -> Outcome:
    """A check that passes when nothing is affected."""
    affected = F.coalesce(affected, F.lit(0)).cast("bigint")
    return Outcome(affected, affected == 0, describe(kind, params, affected=affected, **values))


def not_null(df: DataFrame, column: str, table: str, severity: str = CRITICAL) -> Check:
    def plan(ev):
        return _zero(ev.add(rows_metric(df, F.count_if(F.col(column).isNull()))), "not_null", {"column": column})
    return Check(f"{column}_not_null", table, severity, plan)


def unique(df: DataFrame, columns: Sequence[str], table: str, severity: str = CRITICAL) -> Check:
    columns = tuple(columns)

    def plan(ev):
        # Row count and surplus come from the same groups: one grouped pass, no row pass.
        extra = ev.add(group_metric(df, columns, lambda c: F.sum(c("_n") - 1)))
        total = ev.add(group_metric(df, columns, lambda c: F.coalesce(F.sum(c("_n")), F.lit(0))))
        return _zero(extra, "unique", {"key": "+".join(columns)}, rows=total)
    return Check(f"unique_{'_'.join(columns)}", table, severity, plan)


def non_negative(df: DataFrame, column: str, table: str, severity: str = CRITICAL) -> Check:
    def plan(ev):
        return _zero(ev.add(rows_metric(df, F.count_if(F.col(column) < 0))), "non_negative", {"column": column})
    return Check(f"{column}_non_negative", table, severity, plan)


def greater_than(df: DataFrame, column: str, minimum, table: str, severity: str = CRITICAL) -> Check:
    def plan(ev):
        c = F.col(column)
        return _zero(ev.add(rows_metric(df, F.count_if(c.isNull() | (c <= F.lit(minimum))))),
                     "greater_than", {"column": column, "minimum": minimum})
    return Check(f"{column}_greater_than_{minimum}", table, severity, plan)


def referential_integrity(child: DataFrame, parent: DataFrame, column: str, table: str,
                          parent_table: str, severity: str = CRITICAL) -> Check:
    """Child rows whose key has no parent (a NULL key never has one).

    Both sides are reduced to one row per key with its row count *before* they meet,
    so the shuffle carries distinct keys only and a hot key cannot skew it; the match
    is shared with ``keys_without_match`` over the same pair.
    """
    def plan(ev):
        n = ev.add(coverage_metric(child, parent, column, lambda nc, np_: F.sum(F.when(np_.isNull(), nc))))
        return _zero(n, "references", {"column": column, "parent": parent_table})
    return Check(f"{column}_exists_in_{parent_table}", table, severity, plan)


def constant_in_group(df: DataFrame, group: Sequence[str], column: str, table: str,
                      severity: str = CRITICAL) -> Check:
    """Groups where ``column`` takes more than one non-NULL value (min != max)."""
    group = tuple(group)
    lo, hi = f"_min_{column}", f"_max_{column}"

    def plan(ev):
        n = ev.add(group_metric(df, group, lambda c: F.count_if(c(lo) != c(hi)),
                                inner=[(lo, F.min(column)), (hi, F.max(column))]))
        return _zero(n, "constant", {"column": column, "group": "+".join(group)})
    return Check(f"{column}_constant_per_{'_'.join(group)}", table, severity, plan)


def date_range(df: DataFrame, column: str, start: str, end: str, table: str,
               severity: str = WARNING) -> Check:
    def plan(ev):
        d = F.col(column).cast("date")
        out = d.isNotNull() & ((d < F.lit(start).cast("date")) | (d > F.lit(end).cast("date")))
        lo = ev.add(rows_metric(df, F.min(F.when(out, F.col(column)))))
        hi = ev.add(rows_metric(df, F.max(F.when(out, F.col(column)))))
        outcome = _zero(ev.add(rows_metric(df, F.count_if(out))), "in_range",
                        {"column": column, "from": start, "to": end})
        outcome.details = F.when(outcome.affected > 0, F.create_map(
            F.lit("min"), lo.cast("string"), F.lit("max"), hi.cast("string"))).otherwise(_empty_details())
        return outcome
    return Check(f"{column}_in_range", table, severity, plan)


def keys_without_match(left: DataFrame, right: DataFrame, column: str, table: str,
                       right_table: str, severity: str = WARNING) -> Check:
    """Distinct keys of ``left`` (NULL counts once) that never occur in ``right``."""
    def plan(ev):
        n = ev.add(coverage_metric(left, right, column,
                                   lambda nl, nr: F.count_if(nl.isNotNull() & nr.isNull())))
        return _zero(n, "matched", {"column": column, "other": right_table})
    return Check(f"{column}_matched_in_{right_table}", table, severity, plan)


def expected_count(name: str, table: str, actual, expected, severity: str = CRITICAL) -> Check:
    """Two counts that must be equal; ``actual``/``expected`` are Metrics or ints."""
    actual, expected = _as_metric(actual), _as_metric(expected)

    def plan(ev):
        a = F.coalesce(ev.add(actual), F.lit(0)).cast("bigint")
        e = F.coalesce(ev.add(expected), F.lit(0)).cast("bigint")
        return _zero(F.abs(a - e), "equal", {}, actual=a, expected=e)
    return Check(name, table, severity, plan)


def within_tolerance(name: str, table: str, actual, expected, tolerance=Decimal("0.01"),
                     severity: str = CRITICAL) -> Check:
    """|actual - expected| <= tolerance (a difference equal to the tolerance passes)."""
    actual, expected = _as_metric(actual), _as_metric(expected)

    def plan(ev):
        a = F.coalesce(ev.add(actual), F.lit(0))
        e = F.coalesce(ev.add(expected), F.lit(0))
        return Outcome(F.lit(0).cast("bigint"), F.abs(a - e) <= F.lit(tolerance),
                       describe("close", {"tolerance": tolerance}, actual=a, expected=e))
    return Check(name, table, severity, plan)


def not_greater(name: str, table: str, left, right, severity: str = CRITICAL) -> Check:
    """left <= right."""
    left, right = _as_metric(left), _as_metric(right)

    def plan(ev):
        a = F.coalesce(ev.add(left), F.lit(0))
        b = F.coalesce(ev.add(right), F.lit(0))
        return Outcome(F.lit(0).cast("bigint"), a <= b, describe("at_most", {}, actual=a, limit=b))
    return Check(name, table, severity, plan)


def no_rows(name: str, table: str, violations: DataFrame, severity: str = CRITICAL) -> Check:
    """A query that must return nothing (data-test style); affected = rows it returns."""
    def plan(ev):
        return _zero(ev.add(frame_metric(violations, F.count(F.lit(1)))), "no_rows", {})
    return Check(name, table, severity, plan)


def not_empty(name: str, table: str, rows: Metric, severity: str = CRITICAL) -> Check:
    """At least one row; ``affected`` is the row count."""
    def plan(ev):
        n = F.coalesce(ev.add(rows), F.lit(0)).cast("bigint")
        return Outcome(n, n > 0, describe("not_empty", {}, rows=n))
    return Check(name, table, severity, plan)


def known(name: str, table: str, affected: int, message: str, severity: str = CRITICAL,
          details: dict | None = None) -> Check:
    """A result known on the driver (a header, a listing): passes when nothing is affected."""
    def plan(ev):
        det = _empty_details()
        if details:
            det = F.create_map(*[x for k, v in details.items() for x in (F.lit(k), F.lit(str(v)))])
        return Outcome(F.lit(affected).cast("bigint"), F.lit(affected == 0), F.lit(message), det)
    return Check(name, table, severity, plan)


def with_severities(checks: Sequence[Check], severities: dict[str, str] | None) -> list[Check]:
    """The checks with some severities replaced, by check name or ``table.check``."""
    given = severities or {}
    wrong = set(given.values()) - {CRITICAL, WARNING}
    if wrong:
        raise ValueError(f"unknown severity {sorted(wrong)[0]!r}")
    return [c.with_severity(given.get(f"{c.table}.{c.name}", given.get(c.name, c.severity))) for c in checks]


# --- evaluation, gate, report ---------------------------------------------


def evaluate(checks: Sequence[Check], measured: tuple[DataFrame, Sequence] | None = None) -> DataFrame:
    """All checks as one results frame (one row per check, in the given order).

    ``measured``: a frame and the values of its ``row_measures``, taken while it was written; its rows are not read again.
    """
    ev = _Measured(*measured) if measured else Evaluator()
    planned = [(c, c.plan(ev)) for c in checks]
    wide = ev.wide()
    structs = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.severity).alias("severity"),
            F.when(F.coalesce(o.ok, F.lit(False)), F.lit(OK)).otherwise(F.lit(FAIL)).alias("result"),
            o.affected.cast("bigint").alias("affected_rows"),
            o.message.cast("string").alias("message"),
            o.details.alias("details"),
        )
        for c, o in planned
    ]
    return wide.select(F.inline(F.array(*structs)))


def summary(results: DataFrame) -> DataFrame:
    """total, ok, critical failed, warnings."""
    failed = F.col("result") == FAIL
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("result") == OK).alias("ok"),
        F.count_if(failed & (F.col("severity") == CRITICAL)).alias("critical_failed"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("warnings"),
    )


@dataclass(frozen=True)
class Verdict:
    """What a set of results means for a run: it may go on unless a CRITICAL check failed."""

    context: str
    results: tuple
    blocking: tuple
    advisory: tuple

    @property
    def passed(self) -> bool:
        return not self.blocking

    def require(self) -> "Verdict":
        """Itself, or DataQualityError naming the blocking checks and carrying every result."""
        if self.blocking:
            names = [f"{r['table_name']}/{r['check']} ({r['message']})" for r in self.blocking]
            raise DataQualityError(f"{self.context}: blocked by " + ", ".join(names), list(self.results))
        return self

    def table(self) -> str:
        """The results as aligned text, one line a check."""
        cells = [("table", "check", "severity", "result", "affected", "message")]
        cells += [tuple(str(r[c]) for c in ("table_name", "check", "severity", "result", "affected_rows", "message"))
                  for r in self.results]
        width = [max(len(row[k]) for row in cells) for k in range(6)]
        return "\n".join("  ".join(v.ljust(w) for v, w in zip(row, width)).rstrip() for row in cells)


def verdict(results: DataFrame | list, context: str) -> Verdict:
    """Judge results (one row per check, a few dozen at most, so collecting them is bounded)."""
    rows = tuple(results.collect() if isinstance(results, DataFrame) else results)
    failed = [r for r in rows if r["result"] == FAIL]
    return Verdict(context, rows, tuple(r for r in failed if r["severity"] == CRITICAL),
                   tuple(r for r in failed if r["severity"] != CRITICAL))


def log_verdict(v: Verdict, log: logging.Logger) -> None:
    """One record a run: the table of results, at the level of the worst of them."""
    level = logging.ERROR if v.blocking else logging.WARNING if v.advisory else logging.INFO
    log.log(level, "%s: %d checks, %d blocking, %d advisory\n%s", v.context, len(v.results), len(v.blocking),
            len(v.advisory), v.table())


def report_frame(spark: SparkSession, rows: list, status: str, duration_seconds: float | None = None,
                 run_id: str | None = None) -> DataFrame:
    """The collected results of one run as a report frame (run columns + one row per check)."""
    base = spark.createDataFrame([tuple(r[f.name] for f in RESULT_SCHEMA.fields) for r in rows], RESULT_SCHEMA)
    return base.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.date_trunc("second", F.current_timestamp()).alias("run_at"),
        F.lit(status).alias("status"),
        F.lit(None if duration_seconds is None else round(duration_seconds, 1)).cast("double")
        .alias("duration_seconds"),
        *base.columns,
    )


def write_report(spark: SparkSession, rows: list, dest: str, status: str,
                 duration_seconds: float | None = None, run_id: str | None = None) -> DataFrame:
    """Append the results of one run to a JSON report table (keeps run history)."""
    frame = report_frame(spark, rows, status, duration_seconds, run_id)
    frame.coalesce(1).write.mode("append").json(dest)
    return frame


#: The report table's columns: the run's, then one check's.
REPORT_SCHEMA = StructType([
    StructField("run_id", StringType()), StructField("run_at", TimestampType()),
    StructField("status", StringType()), StructField("duration_seconds", DoubleType()), *RESULT_SCHEMA.fields])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report table by its schema; its history is not scanned to infer one."""
    return spark.read.schema(REPORT_SCHEMA).json(path)


def run_history(report: DataFrame) -> DataFrame:
    """Each check of each run against the runs before: change in affected rows, first failing run, length of its streak.

    ``report`` is a report table; runs follow each other by time, then run_id. A check that a run did not reach has no
    row there and breaks no streak. Windows are per check, so the work is spread over the checks' histories.
    """
    of = Window.partitionBy("table_name", "check").orderBy("run_at", "run_id")
    so_far = of.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    failed = F.col("result") == FAIL
    turned = F.coalesce((F.lag("result").over(of) != F.col("result")).cast("int"), F.lit(1))
    marked = report.select(
        "table_name", "check", "run_id", "run_at", "result", "affected_rows",
        F.row_number().over(of).alias("run_number"), (F.col("affected_rows") - F.lag("affected_rows").over(of)).alias("change"),
        F.min(F.when(failed, F.struct("run_at", "run_id"))).over(so_far)["run_id"].alias("first_failing_run"),
        F.sum(failed.cast("int")).over(so_far).alias("failures"), turned.alias("turned"))
    numbered = marked.withColumn("streak_number", F.sum("turned").over(so_far))
    streak = Window.partitionBy("table_name", "check", "streak_number").orderBy("run_at", "run_id")
    return numbered.withColumn("streak", F.row_number().over(streak)).select(
        "run_id", "run_at", "table_name", "check", "result", "affected_rows", "run_number", "change", "first_failing_run",
        "failures", "streak")
