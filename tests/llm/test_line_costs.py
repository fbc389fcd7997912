"""What makes line dedup cheap changes no row: places as longs, keys met by hash tables, common ends cut before verification."""

import pytest
from pyspark.sql import functions as F

from strata.llm import line_dedup


@pytest.mark.parametrize(("ids", "kind"), [
    ([0, 5, 2**32 - 1], "bigint"), ([-2**32, -1, 7], "bigint"), ([0, 5, 2**32], "decimal(31,0)"), ([-2**62, 0, 2**62], "decimal(31,0)")])
def test_places_are_longs_where_they_fit_and_lead_back_to_the_line(spark, ids, kind):
    place, first = line_dedup._places(min(ids), max(ids))
    rows = spark.createDataFrame([(i, n) for i in ids for n in (0, 3, 2**31 - 2)], "doc_id long, line_no int")
    placed = rows.select("doc_id", "line_no", place.alias("place"))
    assert dict(placed.dtypes)["place"] == kind
    got = placed.select("doc_id", "line_no", "place", first.alias("f")).orderBy("place").collect()
    assert [(r["doc_id"], r["line_no"]) for r in got] == sorted((r["doc_id"], r["line_no"]) for r in got)
    assert all(tuple(r["f"]) == (r["doc_id"], r["line_no"]) for r in got) and len(got) == 9


@pytest.mark.parametrize("shift", [0, 2**40, -2**50])
def test_the_first_of_equal_lines_stays_whatever_the_ids(spark, shift):
    docs = spark.createDataFrame([(3 + shift, "x\nsame line\nsame line"), (1 + shift, "y\nsame line"), (2 + shift, None)],
                                 "doc_id long, text string")
    got = {r["doc_id"] - shift: r["removed"] for r in line_dedup.report(docs).collect()}
    assert got == {3: [1, 2], 1: [], 2: []}


def test_keys_that_fit_memory_meet_by_hash_and_others_are_sorted_with_the_same_links(spark, monkeypatch):
    words = [f"w{k}" for k in range(10)]
    docs = spark.createDataFrame([(i, "\n".join(" ".join([*words[:k], f"{i % 4} {k}", *words[k:]]) for k in range(5)) + f"\nown{i} a b c d e f g h")
                                  for i in range(12)], "doc_id long, text string")
    hints, hint = [], type(docs).hint
    monkeypatch.setattr(type(docs), "hint", lambda self, name, *a: hints.append(name) or hint(self, name, *a))
    run = lambda: sorted(map(tuple, line_dedup.report(docs).collect()))
    hashed = run()
    assert hints == ["shuffle_hash"]
    monkeypatch.setattr(line_dedup, "HASHED", 0)
    assert run() == hashed and hints == ["shuffle_hash"] and sum(r[4] for r in hashed) > 0


def test_only_what_lies_between_common_ends_is_folded(spark):
    rows = [("abcdef", "abxdef"), ("abab", "ab"), ("abc", "abc"), ("", ""), ("ab", ""), ("aab", "ab")]
    got = spark.createDataFrame([(list(x), list(y)) for x, y in rows], "x array<string>, y array<string>").select(
        line_dedup._cut(F.col("x"), F.col("y")).alias("t")).collect()
    assert [("".join(r["t"]["a"]), "".join(r["t"]["b"])) for r in got] == [
        ("cdef", "xdef"), ("ab", ""), ("", ""), ("", ""), ("ab", ""), ("ab", "b")]


def test_lines_are_counted_with_empty_ones(spark):
    texts = {0: None, 1: "", 2: "\n\n", 3: "a\n", 4: "ä\nß\r\n", 5: "a"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["n_lines"] for r in line_dedup.report(docs).collect()}
    assert got == {i: len((t or "").split("\n")) for i, t in texts.items()}
