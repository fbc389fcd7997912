"""Iterations end with their result, not at a number of rounds; samples and scratch stay bounded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import components, decontaminate, language_id, mixing, shared
from strata.llm import textbatch as tb
from strata.llm.ship import ship
from tests.llm import corpus


def test_components_of_a_long_chain(spark, monkeypatch):
    rounds = []
    stored = components.stored
    monkeypatch.setattr(components, "stored", lambda df, kind: rounds.append(kind) or stored(df, kind))
    ids = np.random.default_rng(5).permutation(1500).tolist()
    chain = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    assert {r["component"] for r in components.components(chain).collect()} == {0}
    assert len(rounds) > 3


def test_the_mix_meets_targets_of_uneven_sizes(spark):
    rows = [(k, "a", "w " * (1 if k % 50 else 4000)) for k in range(400)] + [(k, "b", "x " * 30) for k in range(400, 900)]
    rows += [(k, "c", "y " * (k % 7)) for k in range(900, 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    counts = mixing.sizes(docs).groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"))
    solved = mixing.solve(counts, mixing.targets(counts))
    got = (counts.join(solved, "key").groupBy("key", "target").agg(F.sum(
        F.col("n") * F.col("size") * mixing.rate(F.col("tilt"), F.col("size"), F.col("mean"))).alias("got")).collect())
    assert len(got) == 3
    assert all(r["got"] == pytest.approx(r["target"], rel=1e-6, abs=0.02) for r in got)


def test_the_vocabulary_loses_no_term():
    terms = tb.mix(np.arange(5000, dtype=np.uint64))
    w = decontaminate.Windows([], 10)
    w.terms = terms[:2500]
    marks = decontaminate.vocabulary_marks([w])
    found = decontaminate.marked(terms, marks)
    assert found[:2500].all() and found[2500:].mean() < 0.01


def test_an_index_of_few_marks_gives_equal_matches(spark):
    ship(spark)
    rows = corpus.rows(3)
    docs = corpus.frame(spark, rows)
    items = spark.createDataFrame([("x", docs.filter("length(text) > 200").first()["text"])], "item_id string, text string")
    key = lambda df: sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], r["hits"]) for r in df.collect())
    expected = key(decontaminate.find(docs, items))
    assert key(decontaminate.find(docs, items, vocabulary_bits=4)) == expected and any(h for *_, h in expected)


@pytest.mark.parametrize("spare", [2, 0.01])
def test_the_language_sample_is_the_first_by_hash(spark, monkeypatch, spare):
    monkeypatch.setattr(language_id, "SPARE", spare)
    rows = [(k, "de" if k % 3 else "fr", f"text {k}" if k % 5 else " ") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("most", F.lit(0))
    docs = docs.withColumn("h", F.lit(1))
    got = language_id.sample(docs, per_language=40)
    hashed = docs.filter(~language_id.held_out() & (F.trim("text") != "")).select(
        "lang", "text", F.xxhash64("doc_id").alias("x")).collect()
    for lang in ("de", "fr"):
        first = sorted((r["x"], r["text"]) for r in hashed if r["lang"] == lang)[:40]
        assert {t for _, t in first} == {t for n, t in got if n == lang and t in {x for _, x in first}}
        assert len({t for n, t in got if n == lang and t.startswith("text")}) == 40


def test_scratch_is_removed(spark):
    df = shared.stored(spark.range(3), "kept")
    assert df.count() == 3 and f"/llm/{spark.sparkContext.applicationId}/" in df.inputFiles()[0]
    folder = shared.scratch_folder(spark)
    shared.drop_scratch(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
