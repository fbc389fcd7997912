"""Jobs with exit codes: Bronze validation, Bronze -> Silver, Silver -> Gold, layer validation.

Every job takes a session and storage URIs (any scheme Spark can write: a shared
filesystem, HDFS, an object store). The pattern for each published table:

    write a new folder -> check what was written (one fused pass) -> verdict
    -> publish it as the table's next version, or discard it

so a table is computed once, checks see exactly the rows that will be published, the old
table stays readable until the new one has passed, and nothing is kept on executors: a
lost one costs its running tasks only. The next table reads what was published.

Reports always contain every result, including the check that stopped the run, and an
unexpected exception ends the run with status ``ERROR`` (exit code 1), never ``OK``.
Atomicity is per table: orders may be published and items then rejected. Severities can be
replaced by check name (``--severity order_items.unique_order_id_order_item_id=WARNING``).

    python -m strata.plans.jobs landing  --source URI --landed URI [--dataset orders order_items]
    python -m strata.plans.jobs bronze   --orders URI --items URI
    python -m strata.plans.jobs silver   --orders URI --items URI --silver URI [--report URI]
    python -m strata.plans.jobs gold     --silver URI --gold URI [--export URI] [--status delivered ...]
    python -m strata.plans.jobs validate --orders URI --items URI --silver URI --gold URI [--upto silver|gold]
    python -m strata.plans.jobs table    --table orders|order_items|order_product_sales --silver URI [--source URI]
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
import uuid
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators import checks as C
from strata.operators import digest as D
from strata.operators import gold as G
from strata.operators import reconcile as R
from strata.operators import silver as S
from strata.operators import statistics as ST
from strata.plans import suites as U
from strata.session import build_session, hadoop_path
from strata.sources import files as io
from strata.sources import tables as T
from strata.sources.schemas import (
    DEFAULT_PERIOD, DEFAULT_VALID_SALE_STATUSES, ORDER_ITEMS_COLUMNS, ORDERS_COLUMNS,
)

log = logging.getLogger("strata.jobs")

ORDERS_TABLE = "orders"
ITEMS_TABLE = "order_items"
SALES_TABLE = "order_product_sales"
GOLD_TABLE = "daily_product_sales"
GOLD_KEYS = ("purchase_date", "product_id")


@dataclass
class JobOutcome:
    status: str  # OK | FAILED | ERROR
    results: list = field(default_factory=list)
    error: str | None = None
    duration_seconds: float = 0.0

    @property
    def exit_code(self) -> int:
        return 0 if self.status == "OK" else 1


def table_uri(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


Severities = dict[str, str] | None


def judge(checks: Sequence[C.Check], context: str, collected: list, severities: Severities = None,
          measured: tuple[DataFrame, Sequence] | None = None) -> None:
    """Evaluate, keep every result, log, and raise on a blocking one."""
    v = C.verdict(C.evaluate(C.with_severities(checks, severities), measured), context)
    collected.extend(v.results)
    C.log_verdict(v, log)
    v.require()


def stage_measured(df: DataFrame, measures: Sequence[Column], dest: str) -> tuple[str, list]:
    """Stage a table and take row aggregates of what is written in the same pass; a retried task counts once."""
    if not measures:
        return io.stage(df, dest), []
    seen = Observation()
    staged = io.stage(df.observe(seen, *[m.alias(f"m{k}") for k, m in enumerate(measures)]), dest)
    return staged, [seen.get[f"m{k}"] for k in range(len(measures))]


SHAPES = {t.called: t.shape for name, t in R.TABLES.items() if not name.startswith("bronze.")}


def counted_surplus(results: Sequence, table: str, shape: ST.Shape) -> dict[tuple[str, ...], int]:
    """Rows beyond the first of their key, by key, where the uniqueness check of a table has counted them."""
    counted = {r["check"]: r["affected_rows"] for r in results if r["table_name"] == table}
    return {k: counted[name] for k in shape.keys if (name := f"unique_{'_'.join(k)}") in counted}


def kept_facts(table: str, df: DataFrame, results: Sequence = ()) -> dict:
    """Statistics of a table of one part, as facts of its version; ``results`` are those of the checks of these rows."""
    shape = SHAPES[table]
    known = counted_surplus(results, table, shape)
    parts = ST.add_counted(ST.measure_parts(df, ST.without(shape, known)), known)
    return {} if parts is None else ST.facts(shape, {"": parts.get("", {"groups": [], "distinct": {}})})


def kept_statistics(spark: SparkSession, silver_root: str, gold_root: str | None) -> dict[str, ST.Statistics]:
    """Statistics in the pointers of the published tables, by the name that relations use."""
    found = {}
    for name, t in R.TABLES.items():
        root = {"silver": silver_root, "gold": gold_root}.get(name.split(".")[0])
        v = T.current(spark, table_uri(root, t.called)) if root else None
        if v and (kept := ST.Statistics.of(t.shape, v.facts, list(v.parts))):
            found[name] = kept
    return found


def publish_checked(df: DataFrame, checks: Callable[[DataFrame], list[C.Check]], dest: str,
                    context: str, collected: list, severities: Severities = None) -> None:
    """Stage -> check what was staged -> switch, or discard. Row checks are measured by the write itself."""
    spark = df.sparkSession
    staged, values = stage_measured(df, C.row_measures(checks(df), df), dest)
    try:
        written, before = io.read_table(spark, staged), len(collected)
        judge(checks(written), context, collected, severities, (written, values))
        io.switch(spark, staged, dest, df.schema, kept_facts(context, written, collected[before:]))
    except BaseException:
        io.discard(spark, staged)
        raise


def _finish(spark: SparkSession, name: str, body: Callable[[list], None],
            report: str | None) -> JobOutcome:
    started = time.time()
    collected: list = []
    outcome = JobOutcome("OK", collected)
    try:
        body(collected)
    except C.DataQualityError as e:
        outcome.status, outcome.error = "FAILED", str(e)
        log.error("%s stopped: %s", name, e)
    except Exception as e:  # noqa: BLE001 - any failure must end as ERROR, never OK
        outcome.status, outcome.error = "ERROR", f"{type(e).__name__}: {e}"
        log.exception("%s failed", name)
    outcome.duration_seconds = time.time() - started
    if report:
        rows = collected or [{  # a run that failed before any check still leaves a trace
            "check": "run", "table_name": name, "severity": C.CRITICAL,
            "result": C.OK if outcome.status == "OK" else C.FAIL, "affected_rows": 0,
            "message": outcome.error or "no checks ran", "details": {}}]
        C.write_report(spark, rows, report, outcome.status, outcome.duration_seconds,
                       run_id=f"{name}-{uuid.uuid4().hex[:12]}")
    return outcome


# --- A8/A10, I2: landing and Bronze --------------------------------------------------


def landing_checks(spark: SparkSession, sources: dict[str, str]) -> list[C.Check]:
    """Each required extract is there: a location that holds at least one file."""
    found = []
    for name, uri in sources.items():
        fs, path = hadoop_path(spark, uri)
        files = [x for x in (fs.globStatus(path.suffix("/*")) if fs.exists(path) and fs.getFileStatus(path).isDirectory()
                             else fs.globStatus(path)) or [] if not x.getPath().getName().startswith(("_", "."))]
        size = sum(x.getLen() for x in files)
        found.append(C.known(f"{name}_landed", name, 0 if files else 1, f"landed files={len(files)} bytes={size}",
                             details=None if files else {"location": uri}))
    return found


def landed_checks(spark: SparkSession, source: str, landed: str, datasets: Sequence[str]) -> list[C.Check]:
    """Each dataset below ``landed`` holds the files below ``source``, line by line the same (by digests, not by size)."""
    found = io.compare_manifests(io.line_manifest(spark, source), io.line_manifest(spark, landed))
    counted = {r["dataset"]: r for r in found.groupBy("dataset").agg(
        *[F.count_if(F.col("status") == k).alias(k) for k in io.STATUSES]).collect()}
    checks = []
    for name in dict.fromkeys([*datasets, *sorted(counted)]):
        n = {k: counted[name][k] if name in counted else 0 for k in io.STATUSES}
        wrong = sum(n.values()) - n["same"] + (0 if name in counted else 1)
        checks.append(C.known(f"{name}_unchanged", name, wrong, "files " + " ".join(f"{k}={v}" for k, v in n.items())))
    return checks


def verify_landing(spark: SparkSession, source: str, landed: str, datasets: Sequence[str] = (ORDERS_TABLE, ITEMS_TABLE),
                   report: str | None = None, severities: Severities = None) -> JobOutcome:
    """Proof that what landed is what was sent: every file of every dataset (a folder each) by the digest of its lines."""
    return _finish(spark, "verify_landing", lambda collected: judge(
        landed_checks(spark, source, landed, datasets), "landing", collected, severities), report)


def bronze_checks(spark: SparkSession, files: Sequence[tuple[str, str, Sequence[str]]]) -> list[C.Check]:
    """Readable, expected columns present, not empty; per (name, uri, expected columns)."""
    checks: list[C.Check] = []
    for name, uri, expected in files:
        try:
            read, error = io.read_csv_by_name(spark, uri, expected), None
        except Exception as e:  # noqa: BLE001 - an unreadable file is a failed check
            read, error = None, str(e)
        checks += U.bronze_suite(name, read, expected, error)
    return checks


def validate_bronze(spark: SparkSession, orders_uri: str, items_uri: str,
                    report: str | None = None, severities: Severities = None) -> JobOutcome:
    sources = [(ORDERS_TABLE, orders_uri, ORDERS_COLUMNS), (ITEMS_TABLE, items_uri, ORDER_ITEMS_COLUMNS)]
    return _finish(spark, "validate_bronze", lambda collected: judge(
        bronze_checks(spark, sources), "bronze", collected, severities), report)


# --- I1/I5: Bronze -> Silver --------------------------------------------------------


def silver_orders_job(spark: SparkSession, orders_uri: str, silver_root: str, collected: list,
                      period: Sequence[str] = DEFAULT_PERIOD, severities: Severities = None) -> None:
    bronze = io.read_csv_by_name(spark, orders_uri, ORDERS_COLUMNS).frame
    publish_checked(S.orders(bronze), lambda df: U.orders_suite(df, period),
                    table_uri(silver_root, ORDERS_TABLE), ORDERS_TABLE, collected, severities)


def silver_items_job(spark: SparkSession, items_uri: str, silver_root: str, collected: list,
                     period: Sequence[str] = DEFAULT_PERIOD, severities: Severities = None) -> None:
    bronze = io.read_csv_by_name(spark, items_uri, ORDER_ITEMS_COLUMNS).frame
    publish_checked(S.order_items(bronze), lambda df: U.order_items_suite(df, period),
                    table_uri(silver_root, ITEMS_TABLE), ITEMS_TABLE, collected, severities)


def silver_sales_job(spark: SparkSession, silver_root: str, collected: list, severities: Severities = None) -> None:
    items = io.read_table(spark, table_uri(silver_root, ITEMS_TABLE))
    orders = io.read_table(spark, table_uri(silver_root, ORDERS_TABLE))
    publish_checked(S.order_product_sales(items, orders),
                    lambda df: U.sales_suite(df, items, orders),
                    table_uri(silver_root, SALES_TABLE), SALES_TABLE, collected, severities)


def run_silver(spark: SparkSession, orders_uri: str, items_uri: str, silver_root: str,
               report: str | None = None, period: Sequence[str] = DEFAULT_PERIOD,
               severities: Severities = None) -> JobOutcome:
    """Landing check, then orders, items and sales; stops at the first blocking result.

    A missing extract is reported before anything is written; landing results that pass
    are logged only, so a full run reports the 23 checks of the three tables.
    """
    def body(collected):
        landed = C.verdict(C.evaluate(landing_checks(spark, {ORDERS_TABLE: orders_uri, ITEMS_TABLE: items_uri})),
                           "landing")
        C.log_verdict(landed, log)
        if not landed.passed:
            collected.extend(landed.results)
            landed.require()
        silver_orders_job(spark, orders_uri, silver_root, collected, period, severities)
        silver_items_job(spark, items_uri, silver_root, collected, period, severities)
        silver_sales_job(spark, silver_root, collected, severities)
    return _finish(spark, "run_silver", body, report)


def run_table(spark: SparkSession, table: str, silver_root: str, source_uri: str | None = None,
              report: str | None = None, period: Sequence[str] = DEFAULT_PERIOD,
              severities: Severities = None) -> JobOutcome:
    """One Silver table on its own."""
    def body(collected):
        if table == ORDERS_TABLE:
            silver_orders_job(spark, source_uri, silver_root, collected, period, severities)
        elif table == ITEMS_TABLE:
            silver_items_job(spark, source_uri, silver_root, collected, period, severities)
        elif table == SALES_TABLE:
            silver_sales_job(spark, silver_root, collected, severities)
        else:
            raise ValueError(f"unknown table {table!r}")
    return _finish(spark, f"run_{table}", body, report)


# --- I3: Silver -> Gold ------------------------------------------------------------


NO_MONTH = "none"
#: Changes when the model's rule does, so that no month built by another rule is kept.
GOLD_RULE = 1


def month_digests(sales: DataFrame) -> dict[str, str]:
    """Content digest of each month of sales: one map-side aggregation, a row for each month of the calendar."""
    month = F.coalesce(F.date_format("purchase_date", "yyyy-MM"), F.lit(NO_MONTH)).alias("month")
    return {r["month"]: "-".join(str(r[m]) for m in D.MEASURES)
            for r in D.digest(sales, [month], columns=sales.columns).collect()}


def build_gold(spark: SparkSession, silver_root: str, gold_root: str, export_root: str | None = None,
               valid_sale_statuses: Sequence[str] = DEFAULT_VALID_SALE_STATUSES,
               report: str | None = None, severities: Severities = None, full: bool = False) -> JobOutcome:
    """Daily sales model; built from Silver without touching it. An empty one is never published.

    Incremental: the valid sales of each month are digested and compared with the digests stored at the last build.
    Only months whose content differs (new sales, corrected ones, another status list) are computed and written, as
    parts of their own; the next version names the other months' files again. ``full`` builds every month.
    """
    def body(collected):
        staging = G.staging(io.read_table(spark, table_uri(silver_root, SALES_TABLE)))
        dest = table_uri(gold_root, GOLD_TABLE)
        sales = G.valid_sales(staging, valid_sale_statuses)
        months = month_digests(sales)
        last = T.current(spark, dest)
        before = last.facts.get("months", {}) if last and not full and last.facts.get("rule") == GOLD_RULE else {}
        kept = {m: last.parts[m] for m, d in months.items() if before.get(m) == d and m in last.parts}
        todo = sorted(set(months) - set(kept))
        month = F.coalesce(F.date_format("purchase_date", "yyyy-MM"), F.lit(NO_MONTH))
        chosen = sales.filter(month.isin(todo)) if kept else sales
        # Rebalanced, so that a month is few files, and a large one several tasks.
        built = G.daily_product_sales(chosen, valid_sale_statuses).withColumn("month", month)
        staged = T.stage(built.hint("rebalance", "month"), dest, ["month"])
        schema = built.drop("month").schema
        try:
            folder = staged.rsplit("/", 1)[1]
            parts = {**kept, **{m: f"{folder}/month={m}" for m in todo}}
            gold = T.frame(spark, dest, T.Version(0, parts, schema))
            # A status list that matches nothing empties both sides of the reconciliation.
            judge([*U.gold_contract(gold, staging), *U.gold_tests(gold, staging, valid_sale_statuses),
                   C.not_empty("gold_not_empty", GOLD_TABLE, C.row_count(gold))], GOLD_TABLE, collected, severities)
            shape = SHAPES[GOLD_TABLE]
            # No key twice in all of Gold: none in any part either, so a part has as many keys as rows.
            single = any(r["check"] == f"grain_{'_'.join(GOLD_KEYS)}" and r["affected_rows"] == 0 for r in collected)
            told = (last.facts.get("statistics") or {}) if last else {}
            old = told["parts"] if told.get("shape") == ST.said(shape) else {}
            # Kept months were measured when they were built.
            unknown = {m: p for m, p in parts.items() if m not in kept or m not in old}
            fresh = T.frame(spark, dest, T.Version(0, unknown, schema))
            known = {tuple(GOLD_KEYS): 0} if single else {}
            measured = ST.add_counted(ST.measure_parts(fresh, ST.without(shape, known), month), known) if unknown else {}
            statistics = {m: measured[m] if m in unknown else old[m] for m in parts}
            T.commit(spark, dest, parts, schema, {"months": months, "rule": GOLD_RULE, "rebuilt": todo,
                                                  **ST.facts(shape, statistics, ST.measure_whole(gold, shape))},
                     follows=last.number if last else 0)
        except BaseException:
            T.discard(spark, staged)
            raise
        log.info("%s: %d months built, %d kept", GOLD_TABLE, len(todo), len(kept))
        T.expire(spark, dest)
        if export_root:
            io.export_sorted(io.read_table(spark, dest), table_uri(export_root, GOLD_TABLE), GOLD_KEYS)
    return _finish(spark, "build_gold", body, report)


# --- I4/H8: cross-layer validation ---------------------------------------------------


def layer_frames(spark: SparkSession, orders_uri: str, items_uri: str, silver_root: str,
                 gold_root: str | None) -> R.LayerFrames:
    return R.LayerFrames(
        bronze_orders=io.read_csv_by_name(spark, orders_uri, ORDERS_COLUMNS).frame,
        bronze_items=io.read_csv_by_name(spark, items_uri, ORDER_ITEMS_COLUMNS).frame,
        orders=io.read_table(spark, table_uri(silver_root, ORDERS_TABLE)),
        items=io.read_table(spark, table_uri(silver_root, ITEMS_TABLE)),
        sales=io.read_table(spark, table_uri(silver_root, SALES_TABLE)),
        gold=io.read_table(spark, table_uri(gold_root, GOLD_TABLE)) if gold_root else None,
    )


def validate_layers(spark: SparkSession, orders_uri: str, items_uri: str, silver_root: str,
                    gold_root: str | None = None, upto: str = R.THROUGH_GOLD,
                    valid_sale_statuses: Sequence[str] = DEFAULT_VALID_SALE_STATUSES,
                    report: str | None = None, severities: Severities = None, scan: bool = False) -> JobOutcome:
    """4 checks with ``upto='silver'``, 8 with ``upto='gold'``.

    Published tables are judged by the statistics kept with their versions, so only the Bronze extracts are read;
    ``scan`` measures every table's rows again, in one fused pass, with equal results.
    """
    def body(collected):
        frames = layer_frames(spark, orders_uri, items_uri, silver_root,
                              gold_root if upto == R.THROUGH_GOLD else None)
        gold = gold_root if upto == R.THROUGH_GOLD else None
        kept = {} if scan else kept_statistics(spark, silver_root, gold)
        metrics = R.LayerMetrics(frames, valid_sale_statuses, kept)
        row = metrics.frame().collect()[0]  # one row of scalars
        summary = R.layer_summary(spark.createDataFrame([row]))
        log.info("rows by layer: %s", {f"{r['layer']}.{r['table_name']}": r["rows"] for r in summary.collect()})
        fixed = R.LayerMetrics.from_values(row.asDict())
        judge(R.layer_checks(fixed, upto), "layers", collected, severities)
    return _finish(spark, "validate_layers", body, report)


# --- CLI ---------------------------------------------------------------------------------


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    t = sub.add_parser("table")
    t.add_argument("--table", required=True, choices=(ORDERS_TABLE, ITEMS_TABLE, SALES_TABLE))
    t.add_argument("--silver", required=True)
    t.add_argument("--source")
    t.add_argument("--report")
    t.add_argument("--period", nargs=2, default=list(DEFAULT_PERIOD))
    t.add_argument("--severity", nargs="*", default=[])
    for name in ("landing", "bronze", "silver", "gold", "validate"):
        p = sub.add_parser(name)
        p.add_argument("--report")
        p.add_argument("--severity", nargs="*", default=[], metavar="CHECK=SEVERITY")
        if name == "landing":
            p.add_argument("--source", required=True)
            p.add_argument("--landed", required=True)
            p.add_argument("--dataset", nargs="*", default=[ORDERS_TABLE, ITEMS_TABLE])
        if name in ("bronze", "silver", "validate"):
            p.add_argument("--orders", required=True)
            p.add_argument("--items", required=True)
        if name in ("silver", "gold", "validate"):
            p.add_argument("--silver", required=True)
        if name in ("gold", "validate"):
            p.add_argument("--gold", required=(name == "gold"))
            p.add_argument("--status", nargs="*", default=list(DEFAULT_VALID_SALE_STATUSES))
        if name == "gold":
            p.add_argument("--export")
            p.add_argument("--full", action="store_true")
        if name == "validate":
            p.add_argument("--upto", choices=(R.SILVER_ONLY, R.THROUGH_GOLD), default=R.THROUGH_GOLD)
            p.add_argument("--scan", action="store_true")
        if name == "silver":
            p.add_argument("--period", nargs=2, default=list(DEFAULT_PERIOD))
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")

    severities = dict(x.split("=", 1) for x in args.severity)
    spark = build_session(f"strata-{args.job}")
    if args.job == "table":
        out = run_table(spark, args.table, args.silver, args.source, args.report, tuple(args.period), severities)
    elif args.job == "landing":
        out = verify_landing(spark, args.source, args.landed, args.dataset, args.report, severities)
    elif args.job == "bronze":
        out = validate_bronze(spark, args.orders, args.items, args.report, severities)
    elif args.job == "silver":
        out = run_silver(spark, args.orders, args.items, args.silver, args.report, tuple(args.period), severities)
    elif args.job == "gold":
        out = build_gold(spark, args.silver, args.gold, args.export, args.status, args.report, severities,
                         args.full)
    else:
        out = validate_layers(spark, args.orders, args.items, args.silver, args.gold, args.upto,
                              args.status, args.report, severities, args.scan)
    log.info("%s finished: %s (%.1f s)", args.job, out.status, out.duration_seconds)
    return out.exit_code


if __name__ == "__main__":
    sys.exit(main())
