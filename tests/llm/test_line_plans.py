"""What line dedup asks of the driver and of each line: small plans, few keys, words by every kind of space."""

import random

import pytest
from pyspark.sql import functions as F

from strata.llm import line_dedup


def _coded(spark, rows):
    """worded, m and codes of (worded, unit codes)."""
    return spark.createDataFrame([(i, w, len(c), c) for i, (w, c) in enumerate(rows)],
                                 "i int, worded boolean, m int, codes array<int>")


def test_the_last_plan_reads_links_that_were_written(spark):
    docs = spark.createDataFrame(
        [(i, f"one two three four five six seven eight nine ten w{i}\nalone{i} b{i}") for i in range(40)], "doc_id long, text string")
    plan = line_dedup.report(docs)._jdf.queryExecution().sparkPlan().toString()
    # The joins of the links themselves (15 of them with the last ones) are not in it.
    assert plan.count("Join") <= 4


def test_long_lines_are_sought_by_the_keys_of_all_edits_alone(spark):
    rows = _coded(spark, [(True, list(range(30))), (False, list(range(18))), (False, list(range(17))), (True, list(range(8)))])
    got = [r["k"] for r in rows.orderBy("i").select(line_dedup.probe_keys(2).alias("k")).collect()]
    assert len(got[0]) == len(got[1]) == 12 and None not in got[0] + got[1]
    assert len(got[2]) == len(got[3]) == 16 and got[3].count(None) == 4


@pytest.mark.parametrize("worded", [True, False])
def test_a_line_seeks_every_line_within_two_edits(spark, worded):
    rng = random.Random(5)
    rows = []
    for m in [*range(8, 24), 40]:
        for _ in range(6):
            a = [rng.randrange(1000) for _ in range(m)]
            b = list(a)
            edits = 2 if worded or m >= 18 else 1
            for _ in range(edits):
                at, kind = rng.randrange(len(b)), rng.randrange(3)
                b[at: at + (kind > 0)] = [rng.randrange(1000)] if kind < 2 else []
            if len(b) >= (8 if worded else line_dedup.PER_EDIT * edits):
                rows.append((a, b) if len(a) >= len(b) else (b, a))
    longer = _coded(spark, [(worded, a) for a, _ in rows]).select("i", line_dedup.probe_keys(2).alias("sought"))
    other = _coded(spark, [(worded, b) for _, b in rows]).select("i", line_dedup.index_keys(2).alias("held"))
    met = longer.join(other, "i").select("i", F.arrays_overlap(F.array_compact("sought"), "held").alias("met")).collect()
    assert len(met) == len(rows) > 60 and all(r["met"] for r in met)


def test_words_part_at_every_kind_of_space(spark):
    texts = ["a b", "a\tb", "\x0ba\x0c b\r", "  a  b  ", "a b", "\t", ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, line string").orderBy("i")
    got = [r["w"] for r in rows.select(line_dedup._words(F.col("line")).alias("w")).collect()]
    assert got == [["a", "b"]] * 4 + [["a b"], [], []]


def test_parities_of_lines_two_edits_apart_differ_in_four_at_most(spark):
    rng = random.Random(6)
    codes = [rng.randrange(-2**31, 2**31) for _ in range(30)]
    other = [*codes[:5], rng.randrange(-2**31, 2**31), *codes[6:20], *codes[21:]]
    a, b = (r["p"] for r in _coded(spark, [(True, codes), (True, other)]).orderBy("i").select(line_dedup.parity().alias("p")).collect())
    assert a >= 0 and b >= 0 and (a ^ b).bit_count() <= 4
