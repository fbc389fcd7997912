"""Row checks measured while a table is written: no extra scan, the same results, retried tasks counted once."""

import os
import subprocess
import sys

import pytest

from strata.operators import checks as C
from strata.operators import silver as S
from strata.plans import jobs as J
from strata.plans import suites as U
from strata.sources import files as io
from tests.fixtures import items, orders, random_items, random_orders

PERIOD = ("2017-01-01", "2017-12-31")


def rows(df):
    return [tuple(sorted(v.items()) if isinstance(v, dict) else v for v in r) for r in df.collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
@pytest.mark.parametrize("n", [0, 300])
def test_measured_results_equal_evaluated_ones(spark, tmp_uri, n, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for df, suite in ((S.orders(orders(spark, random_orders(3, n))), U.orders_suite),
                          (S.order_items(items(spark, random_items(4, n))), U.order_items_suite)):
            staged, values = J.stage_measured(df, C.row_measures(suite(df, PERIOD), df), f"{tmp_uri}/{suite.__name__}")
            written = io.read_table(spark, staged)
            assert len(values) >= 4
            assert rows(C.evaluate(suite(written, PERIOD), (written, values))) == rows(C.evaluate(suite(written, PERIOD)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_row_checks_read_nothing(spark, tmp_uri):
    df = S.order_items(items(spark, random_items(4, 50)))
    only_rows = lambda d: [C.not_null(d, "price", "t"), C.non_negative(d, "price", "t"), C.greater_than(d, "price", 0, "t"),
                           C.date_range(d, "shipping_limit_date", *PERIOD, "t")]
    staged, values = J.stage_measured(df, C.row_measures(only_rows(df), df), f"{tmp_uri}/t")
    written = io.read_table(spark, staged)
    plan = lambda *a: C.evaluate(*a)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan(only_rows(written), (written, values)) and "FileScan" in plan(only_rows(written))
    # With a key check, the one pass left is that of the keys.
    both = lambda d: [*only_rows(d), C.unique(d, ["order_id", "order_item_id"], "t")]
    assert plan(both(written), (written, values)).count("FileScan") == 1
    assert plan(both(written)).count("FileScan") == 2


FLAKY = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from strata.plans import jobs as J

spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())

def flaky(batches):
    for pdf in batches:
        yield pdf
    if TaskContext.get().attemptNumber() < 2 and TaskContext.get().partitionId() == 1:
        raise RuntimeError("lost after its rows were counted")

df = spark.range(0, 1000, 1, 4).mapInPandas(flaky, "id long")
staged, values = J.stage_measured(df, [F.count(F.lit(1)), F.sum("id"), F.count_if(F.col("id") % 10 == 0)], sys.argv[2])
print("MEASURED", values, spark.read.parquet(staged).count())
"""


def test_a_retried_task_counts_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "flaky.py").write_text(FLAKY)
    out = subprocess.run([sys.executable, str(tmp_path / "flaky.py"), root, f"{tmp_path}/t"], capture_output=True, text=True,
                         timeout=300, env={**os.environ, "PYSPARK_SUBMIT_ARGS": "--driver-memory 1g pyspark-shell"})
    assert "MEASURED [1000, 499500, 100] 1000" in out.stdout, out.stdout[-500:] + out.stderr[-1500:]
