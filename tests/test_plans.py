"""Plan shape of the flagship query: what Catalyst must keep doing for us."""

import re

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_plan_pushes_status_filter_and_prunes_adapter_join(spark):
    import __spark_entry__ as E
    p = _plan(E.queries()["daily_product_sales"](spark, SF))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", p)
    assert any("EqualTo(o_orderstatus,F)" in x for x in pushed)
    # lineitem once (items) and orders once: the carrier-date aggregate + join is pruned
    assert p.count("FileScan parquet") == 2
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
    # reads only the columns it needs
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert all("l_discount" not in s and "o_totalprice" not in s for s in schemas)


def test_check_suites_never_cross_join(spark):
    import __spark_entry__ as E
    for name in ("quality_summary", "reconcile_layers", "gold_tests", "layer_summary"):
        p = _plan(E.queries()[name](spark, SF))
        assert "CartesianProduct" not in p and "NestedLoopJoin" not in p, name
