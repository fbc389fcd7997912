"""Operators on documents against brute force, and their defined results for odd rows and empty tables."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import (
    decontaminate,
    language_id,
    line_dedup,
    mixing,
    near_dup,
    quality_rules,
    substring_dedup,
    suffix_dedup,
)
from strata.llm.ship import ship
from tests.llm import brute, corpus



@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return corpus.frame(spark, corpus.rows(7)).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark):
    ship(spark)
    return corpus.frame(spark, corpus.odd_rows()).repartition(2).cache()


@pytest.fixture(scope="module")
def none(spark):
    return corpus.frame(spark, [])


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sha(raw):
    return hashlib.sha256(raw).hexdigest()


def test_substring_dedup_matches_brute_force(docs):
    got = {r["doc_id"]: r for r in substring_dedup.digest(substring_dedup.dedup_windows(docs, 8, 3)).collect()}
    for i, gone in brute.windows_removed(pairs(docs), 8).items():
        w = brute.words(dict(pairs(docs))[i])
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), len(gone), sha(kept.encode()))
    assert sum(r["n_removed"] for r in got.values()) > 100


def test_suffix_dedup_matches_brute_force(docs):
    got = {r["doc_id"]: r for r in suffix_dedup.digest(suffix_dedup.dedup_bytes(docs, 40, 8)).collect()}
    for i, gone in brute.bytes_removed(pairs(docs), 40).items():
        raw = dict(pairs(docs))[i].encode()
        spans = sum(k - 1 not in gone for k in gone)
        kept = bytes(b for k, b in enumerate(raw) if k not in gone)
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(raw), len(gone), spans, sha(kept))


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates_match_brute_force(docs, shingle):
    got = near_dup.near_duplicates(docs, shingle).collect()
    size, group = brute.near_groups(pairs(docs), shingle, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (size[i], group[i]) for i in size}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_line_dedup_matches_brute_force(docs):
    got = {r["doc_id"]: r["removed"] for r in line_dedup.removed_lines(docs, 2, 9, 3).collect()}
    expected = brute.lines_removed(pairs(docs), 2, 9, 3)
    assert {i: r for i, r in got.items() if r} == {i: r for i, r in expected.items() if r}
    cut = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, 2, 9, 3).collect()}
    for i, t in pairs(docs):
        assert cut[i] == "\n".join(x for n, x in enumerate(t.split("\n")) if n not in expected[i])


def test_decontamination_matches_brute_force_in_one_block_or_many(spark, docs):
    text = dict(pairs(docs))
    items = [(str(k), " ".join(brute.terms(text[k])[2:16]).upper()) for k in range(0, 30, 4)]
    items += [("short", "the House-river"), ("none", "--"), ("null", None)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    expected = brute.contaminated(pairs(docs), items, 10)
    for block in (1 << 20, 150):
        got = decontaminate.find(docs, benchmark, block_bytes=block).collect()
        assert {r["doc_id"]: (set(r["hits"]), set(r["items"])) for r in got} == expected
        assert all(set(r["items"]) <= set(r["near_items"]) for r in got)


def test_quality_counts_match_plain_python(docs, odd):
    for df in (docs, odd):
        for r in quality_rules.score(df).join(df.select("doc_id", "text"), "doc_id").collect():
            w = brute.words(r["text"])
            lines = [x for x in (r["text"] or "").split("\n") if brute.words(x)]
            count = Counter(zip(w, w[1:], w[2:]))
            repeated = {k + j for k in range(len(w) - 2) if count[tuple(w[k: k + 3])] > 1 for j in range(3)}
            assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (
                len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(repeated))
            assert r["base_failed"] == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))


def test_many_and_few_repeated_windows_agree(spark, monkeypatch):
    text = " ".join(f"w{k % 90}" for k in range(400)) + " " + " ".join(f"v{k}" for k in range(60))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    n = [quality_rules.score(df).first()["n_repeat_words"]]
    monkeypatch.setattr(quality_rules, "FEW", 1000)
    n.append(quality_rules.score(df).first()["n_repeat_words"])
    assert n == [400, 400]


def test_language_is_found_on_held_out_documents(spark):
    df = corpus.frame(spark, [(k, t, lang, "s", 1, *[None] * 7) for k, (t, lang) in enumerate(corpus.texts(3, 300))])
    got = language_id.identify(df.filter(F.length("text") > 60)).join(df.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(held) > 20 and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_mix_meets_targets(docs):
    got = mixing.mix(docs).collect()
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        s = source[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(size))}
    left, open_, expected = 1.5 * sum(size.values()), set(size), {}
    while True:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > 2 * size[s]}
        if not full:
            break
        for s in full:
            expected[s] = 2 * size[s]
            left -= expected[s]
        open_ -= full
    expected |= {s: level * weights[s] for s in open_}
    assert target == pytest.approx(expected)
    biggest = max(r["size"] for r in got)
    assert all(abs(taken[s] - target[s]) <= biggest for s in size)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(docs).collect()))


OPERATORS = {
    "language": lambda d: language_id.identify(d),
    "suffix": lambda d: suffix_dedup.digest(suffix_dedup.dedup_bytes(d)),
    "lines": lambda d: line_dedup.report(d),
    "substring": lambda d: substring_dedup.digest(substring_dedup.dedup_windows(d)),
    "mix": lambda d: mixing.mix(d),
    "quality": lambda d: quality_rules.digest(quality_rules.score(d)),
    "near": lambda d: near_dup.near_duplicates(d),
    "decontaminate": lambda d: decontaminate.digest(decontaminate.find(d, d.sparkSession.createDataFrame(
        [(1, "the house of stone"), (None, "river"), (2, None)], "item_id long, text string"))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(name, odd, none):
    got = OPERATORS[name](odd).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert set(by_id) == {r["doc_id"] for r in odd.collect()}
    if name in ("near", "lines"):  # repeated rows may be listed once for each
        assert len(got) >= len(by_id)
    else:
        assert len(got) == odd.count()
    assert OPERATORS[name](none).count() == 0
    if name == "language":
        assert all(by_id[i]["lang_pred"] == "und" for i in (100, 101, 102, 103)) and by_id[104]["lang_pred"] == "en"
    if name == "suffix":
        assert by_id[104]["n_removed"] == by_id[104]["n_bytes"] == by_id[105]["n_removed"] and by_id[100]["n_bytes"] == 0
    if name == "substring":
        assert by_id[104]["n_removed"] == 0 and by_id[105]["n_removed"] == by_id[105]["n_words"] and by_id[100]["n_words"] == 0
    if name == "near":
        assert by_id[105]["component_id"] == 104 and all(by_id[i]["kept"] and not by_id[i]["n_shingles"] for i in (100, 101, 102))
    if name == "mix":
        assert by_id[100]["taken"] == by_id[101]["size"] == 0
    if name == "lines":
        assert by_id[105]["removed"] == [0] and by_id[104]["removed"] == []
    if name == "decontaminate":
        assert by_id[100]["n_words"] == 0 and not by_id[100]["contaminated"]
