"""Rows that share a doc_id are documents of their own: text that occurs once stays, wherever it stands."""

import numpy as np
import pytest

import corpus_pipeline as P
from strata.llm import line_dedup, near_dup, substring_dedup, suffix_dedup
from strata.llm import textbatch as tb
from strata.llm.shared import identified
from strata.llm.ship import ship
from tests.llm import brute

A = " ".join(f"amber{k} lamp{k * k}" for k in range(30))
B = " ".join(f"birch{k} stone{k * 7}" for k in range(30))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in [(1, A), (5, A), (5, B)]], COLUMNS).repartition(2)


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_numbers_follow_doc_id_and_are_the_rows_own(spark):
    data = [(None, "n"), (7, "x"), (7, "y"), (7, "x"), (2, "z"), (None, None)]
    got = identified(spark.createDataFrame(data, "doc_id long, text string").repartition(3)).orderBy("__id").collect()
    assert [r["doc_id"] for r in got] == [2, 7, 7, 7, None, None] and len({r["__id"] for r in got}) == 6


def test_words_and_bytes_that_occur_once_stay(docs):
    cut = sorted((r["doc_id"], r["n_removed"], r["kept_text"]) for r in substring_dedup.dedup_windows(docs).collect())
    assert cut == [(1, 0, A), (5, 0, B), (5, 60, "")]
    cut = sorted((r["doc_id"], r["n_removed"]) for r in suffix_dedup.dedup_bytes(docs, 400).collect())
    assert cut == [(1, len(A)), (5, 0), (5, len(A))]


def test_lines_that_occur_once_stay(docs):
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, A), (5, ""), (5, B)]
    assert rows(P.drop_repeated_lines(docs.sparkSession, docs, "")) == [(1, A), (5, B)]


def test_texts_of_one_id_are_not_tied(docs):
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs).collect())
    assert got == [(1, 1, True), (5, 1, False), (5, 5, True)]
    assert rows(P.drop_near_copies(docs.sparkSession, docs, "")) == [(1, A), (5, B)]


def test_only_the_contaminated_text_of_an_id_goes(spark, docs, tmp_path):
    spark.createDataFrame([(1, A[20:200])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows(P.drop_contaminated(spark, docs, str(tmp_path))) == [(5, B)]


def test_columns_with_clashing_names_are_kept(spark):
    ship(spark)
    data = [(1, A, 4, "r", "row", "found"), (2, A + "\n" + B, 5, "s", "row", "found")]
    df = spark.createDataFrame(data, "doc_id long, text string, __id long, removed string, row string, __removed string")
    got = line_dedup.dedup_lines(df).drop("__n_removed").collect()
    assert sorted(map(tuple, got)) == [data[0], (2, B, *data[1][2:])]


@pytest.mark.parametrize("segment", [1, 7, 64, 1000])
def test_texts_over_a_segment(spark, monkeypatch, segment):
    """Every window of a long text is seen once, with its place in the whole text."""
    monkeypatch.setattr(substring_dedup, "SEGMENT", segment)
    text = " \n".join([A, "x" * 300, B, A[:250], " ", "y" * 90, B[100:400]])
    raw = np.frombuffer(text.encode(), np.uint8)
    whole, seen = brute.words(text), []
    for part, edge, _, number in substring_dedup._parts(raw, np.array([3]), 8):
        start, end, _ = tb.words(part, edge)
        own = [part[i:j].tobytes().decode() for i, j in zip(start, end, strict=True)]
        for k in range(len(own) - 7):
            assert own[k: k + 8] == whole[number[0] + k: number[0] + k + 8]
            seen.append(int(number[0]) + k)
    assert seen == list(range(len(whole) - 7))
