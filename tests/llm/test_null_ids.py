"""Rows without doc_id are documents of their own: unrelated ones share no removals, contaminated ones go."""

import corpus_pipeline as P
from strata.llm import line_dedup, substring_dedup, suffix_dedup
from strata.llm.ship import ship

PASSAGE = "seven silver lamps stood along the narrow quay before any of the boats came home"
SHARED = "this very line is repeated in one of the two texts without an id"
UNIQUE = "nothing else in this table resembles the second text at all today"


def frame(spark, data):
    ship(spark)
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in data],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def texts(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in df.collect())


def test_line_numbers_of_one_text_without_id_leave_the_others_alone(spark):
    docs = frame(spark, [(1, SHARED), (None, SHARED + "\nfirst rest"), (None, UNIQUE + "\nsecond rest")])
    got = texts(P.drop_repeated_lines(spark, docs, ""))
    assert got == [(False, 1, SHARED), (True, 0, "first rest"), (True, 0, UNIQUE + "\nsecond rest")]
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in line_dedup.report(docs).collect()) == [(0, 0), (0, 1), (1, 0)]


def test_windows_and_bytes_of_one_text_without_id_leave_the_others_alone(spark):
    docs = frame(spark, [(1, SHARED), (None, SHARED + " more"), (None, UNIQUE + " more words")])
    cut = substring_dedup.dedup_windows(docs, 8, 3).collect()
    assert sorted(r["kept_text"] for r in cut if r["doc_id"] is None) == ["more", UNIQUE + " more words"]
    cut = suffix_dedup.dedup_bytes(docs, 40, 8).collect()
    assert sorted(r["n_removed"] for r in cut if r["doc_id"] is None)[0] == 0
    assert sum(r["n_removed"] for r in cut) >= 2 * len(SHARED)


def test_a_contaminated_text_without_id_goes_and_the_others_stay(spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(1, UNIQUE), (2, "so " + PASSAGE), (None, "and " + PASSAGE), (None, SHARED)])
    assert texts(P.drop_contaminated(spark, docs, str(tmp_path))) == [(False, 1, UNIQUE), (True, 0, SHARED)]


def test_texts_without_id_tie_nothing_and_equal_rows_stay_once(spark):
    docs = frame(spark, [(1, UNIQUE), (2, SHARED), (2, SHARED), (None, UNIQUE), (None, SHARED)])
    got = texts(P.drop_near_copies(spark, docs, ""))
    assert got == [(False, 1, UNIQUE), (False, 2, SHARED), (True, 0, UNIQUE), (True, 0, SHARED)]
