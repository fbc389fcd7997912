"""Lists of keys are counted once, and little of a key is shuffled; links are the same whichever lists are long."""

import pytest

from strata.llm import line_dedup

WORDS = [f"w{k}" for k in range(12)]


def _docs(spark):
    near = [" ".join([*WORDS[:k], f"x{i}", *WORDS[k + 1:]]) for k in range(0, 12, 3) for i in range(4)]
    own = [" ".join(f"own{i}_{k}" for k in range(9)) for i in range(6)]
    rows = [(i, "\n".join([a, "short one", b])) for i, (a, b) in enumerate(zip(near, own * 3, strict=False))]
    return spark.createDataFrame([*rows, (90, None), (91, " \t\n\n")], "doc_id long, text string")


def test_pairs_are_joined_without_counting_the_lists_again(spark, monkeypatch):
    plans, written = {}, line_dedup.stored
    monkeypatch.setattr(line_dedup, "stored", lambda df, kind: plans.setdefault(
        kind, df._jdf.queryExecution().optimizedPlan().toString()) and written(df, kind))
    assert line_dedup.report(_docs(spark)).count() == 18
    assert list(plans).index("long-keys") < list(plans).index("pairs")
    assert "count(1)" in plans["long-keys"] and "count(1)" not in plans["pairs"] and "LeftAnti" in plans["pairs"]
    sides = [x for x in plans["pairs"].splitlines() if "Project [key#" in x and "AS p" in x]
    assert len(sides) == 2 and all(x.split(" AS p")[0].count(", ") <= 3 for x in sides), plans["pairs"]


@pytest.mark.parametrize("wide", [1, 100])
def test_links_do_not_depend_on_which_lists_are_long(spark, monkeypatch, wide):
    expected = sorted(map(tuple, line_dedup.report(_docs(spark)).collect()))
    monkeypatch.setattr(line_dedup, "WIDE", wide)
    assert sorted(map(tuple, line_dedup.report(_docs(spark)).collect())) == expected
    assert sum(r[4] for r in expected) > 100
