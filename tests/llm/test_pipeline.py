"""Each stage of the corpus pipeline on what the one before it kept, against brute force."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strata.llm import language_id, line_dedup
from strata.llm.shared import stored
from tests.llm import brute, corpus

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Documents in, the rows out of every stage, and the benchmark."""
    root = str(tmp_path_factory.mktemp("sf"))
    data = corpus.rows(21, 50) + corpus.odd_rows(3)[12:]
    frame = corpus.frame(spark, [(None if r[0] is None else r[0] + (1000 if k >= 50 else 0), *r[1:]) for k, r in enumerate(data)])
    frame.select(*COLUMNS).write.parquet(f"{root}/documents.parquet")
    texts = [r[1] for r in data]
    items = [(k, " ".join(brute.terms(texts[k])[1:14])) for k in (2, 9, 30)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, root), name)
        out.append(docs)
    return spark.read.parquet(f"{root}/documents.parquet"), out, items, root


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def key(pair):
    return (pair[0] is None, pair[0] or 0, pair[1] or "")


def test_stages_keep_the_columns_and_the_last_adds_the_mix(made):
    _, out, _, _ = made
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert all(df.columns == COLUMNS for df in out[:-1])
    assert out[-1].columns == [*COLUMNS, "mix_size", "mix_target", "mix_copies", "mix_taken"]
    assert all(0 < r["mix_taken"] <= 2 * r["mix_size"] or r["mix_size"] == 0 for r in out[-1].collect())


def test_language_stage_drops_texts_without_a_language_only(made):
    docs, out, _, _ = made
    kept = {r[0] for r in rows(out[0])}
    without = {i for i, t in rows(docs) if not any(map(str.isalpha, t or ""))}
    assert without and not kept & without
    judged = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert kept == {i for i, r in judged.items() if r["lang_pred"] != "und" and r["score"] >= language_id.MIN_SCORE}
    assert len(kept) >= 0.9 * (len(judged) - len(without))


def test_line_stage(made):
    _, out, _, _ = made
    # Each row is a document of its own, in the order of doc_id.
    before = sorted(rows(out[0]), key=key)
    gone = brute.lines_removed([(k, t) for k, (_, t) in enumerate(before)], line_dedup.EDITS, line_dedup.MIN_WORDS,
                               line_dedup.MIN_EXACT)
    expected = []
    for k, (i, t) in enumerate(before):
        text = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone.get(k, ()))
        if not gone.get(k) or brute.words(text):
            expected.append((i, text))
    assert sorted(rows(out[1]), key=key) == sorted(expected, key=key)


def test_near_stage(made):
    _, out, _, _ = made
    before = [(i, t) for i, t in rows(out[1]) if i is not None]
    _, group = brute.near_groups(before, P.SHINGLE, P.PERCENT)
    kept = {i for i, _ in rows(out[2]) if i is not None}
    assert kept == {i for i, g in group.items() if i == g}


def test_decontamination_stage(made):
    _, out, items, _ = made
    before = rows(out[2])
    found = brute.contaminated([(i, t) for i, t in before if i is not None], items, 10)
    assert {i for i, _ in rows(out[3]) if i is not None} == {i for i, (hits, _) in found.items() if not hits}


def test_run_gives_what_the_stages_give(spark, made):
    _, out, _, root = made
    got = P.run(spark, root).drop("text").collect()
    assert sorted(map(str, got)) == sorted(map(str, out[-1].drop("text").collect()))
    assert P.ORACLE_SQL is None


def test_an_empty_table(spark, made, tmp_path):
    _, _, _, root = made
    none = spark.read.parquet(f"{root}/documents.parquet").filter(F.lit(False))
    for _, stage in P.STAGES:
        none = stage(spark, none, root)
        assert none.count() == 0
        none = none.select(*COLUMNS)
