"""Rank selection by refinement: few rounds on bad data, small rows between tasks, exact values."""

import numpy as np
import pytest

from strata.operators import quantiles as Q

PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.fixture()
def rounds(monkeypatch):
    seen = []
    plain = Q.counted_slices

    def counted(*given):
        out = plain(*given)
        seen.append(out)
        return out

    monkeypatch.setattr(Q, "counted_slices", counted)
    return seen


def got(df, slices=None):
    return {r["p"]: r["value"] for r in Q.exact_percentiles(df, "x", PROBS, slices).collect()}


def test_an_outlier_costs_one_round_more(spark, rounds):
    df = spark.range(200_000).selectExpr("cast(1 + id / 1e7 as double) as x").repartition(8)
    values = np.array([r["x"] for r in df.collect()])
    assert got(df) == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS}, rel=1e-12)
    plain = len(rounds)
    far = df.unionByName(spark.sql("select 1e18 as x"))
    with_far = np.append(values, 1e18)
    want = {p: float(np.quantile(with_far, p)) for p in PROBS}
    assert got(far) == pytest.approx(want, rel=1e-9)
    assert len(rounds) - plain <= plain + 2 <= 8


def test_no_task_sends_more_rows_than_slices(spark, rounds):
    df = spark.range(100_000).selectExpr("cast(if(id = 0, 1e18, 1 + id % 50000 / 1e6) as double) as x").repartition(4)
    got(df, 300)
    for r in rounds:
        plan = r._jdf.queryExecution().executedPlan().toString()
        intervals = r.select("interval").distinct().count()
        assert "collect_list" not in plan and "collect_set" not in plan and "partial_count" in plan
        assert r.count() <= intervals * 302


def test_many_orders_of_magnitude_and_both_signs(spark, rounds):
    df = spark.range(3000).selectExpr("cast(if(id % 3 = 0, -1, 1) * power(10D, id % 601 - 300) * (1 + id / 7) as double) as x")
    values = np.array([r["x"] for r in df.collect()])
    assert got(df) == pytest.approx({p: float(np.quantile(values, p)) for p in PROBS}, rel=1e-12)
    assert len(rounds) <= 12  # 600 orders of magnitude on either side of zero


def test_extremes_of_doubles_infinities_and_nan(spark):
    df = spark.createDataFrame([(v,) for v in (1e308, -1e308, 5e-324, 0.0, -0.0, float("nan"), None, 2.0, 1e308)], "x double")
    values = np.array([1e308, -1e308, 5e-324, 0.0, -0.0, 2.0, 1e308])
    found = {r["p"]: r["value"] for r in Q.exact_percentiles(df, "x", (0.0, 0.5, 1.0), 2).collect()}
    assert found == {p: float(np.quantile(values, p, method="lower")) for p in (0.0, 0.5, 1.0)}
    ends = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.0,), (2.0,), (3.0,)], "x double")
    found = {r["p"]: r["value"] for r in Q.exact_percentiles(ends, "x", (0.0, 0.25, 0.5, 1.0)).collect()}
    assert found == {0.0: float("-inf"), 0.25: 1.0, 0.5: 2.0, 1.0: float("inf")}


def test_no_values_no_rows_and_one_value(spark):
    assert Q.exact_percentiles(spark.createDataFrame([(None,)], "x double"), "x", PROBS).collect() == []
    assert Q.exact_percentiles(spark.range(0).selectExpr("id as x"), "x", PROBS).collect() == []
    assert got(spark.range(1).selectExpr("id + 5 as x")) == {p: 5.0 for p in PROBS}
    with pytest.raises(ValueError):
        Q.exact_percentiles(spark.range(3), "id", (1.5,))
