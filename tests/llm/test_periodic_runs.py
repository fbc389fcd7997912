"""Periodic runs against brute force over all periods, the planted documents, and odd rows."""

import hashlib
import random
import re
import zlib

import pyarrow as pa
import pytest

from strata.llm import periodic_runs
from strata.llm.ship import ship
from tests.llm import corpus


def brute_runs(words, shortest):
    """Every maximal stretch of every period by direct comparison; of equal stretches the least period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(shortest, 2 * q) and i > s:
                found.setdefault((s, i + q), q)
            i += 1 if i == s else 0
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapse(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(rng, n):
    made = []
    for _ in range(n):
        kinds, size = rng.choice([1, 2, 3, 6, 40]), rng.randint(0, 90)
        words = [f"w{rng.randrange(kinds)}" for _ in range(size)]
        if words and rng.random() < 0.6:
            a = rng.randrange(size)
            p = 1 + (size - a) // rng.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(size)]
        if rng.random() < 0.15:
            x, y = "a", "ab"
            while len(y) < size:
                x, y = y, y + x
            words = list(y[:size])
        made.append(rng.choice([" ", "\n", "\t "]).join(words))
    return made


@pytest.mark.parametrize("shortest", [2, 3, 5, 12])
def test_runs_of_batches_match_brute_force(shortest):
    rng = random.Random(shortest)
    for _ in range(60):
        rows = texts(rng, rng.randint(1, 6))
        row, start, size, period, collapsed, n_words = periodic_runs.batch_runs(pa.array(rows), shortest)
        for k, text in enumerate(rows):
            words = text.split()
            want = brute_runs(words, shortest)
            got = [(int(s), int(e), int(q)) for r, s, e, q in zip(row, start, size, period) if r == k]
            assert got == sorted(want, key=lambda x: (x[0], x[2]))
            assert collapsed[k].as_py() == collapse(words, want) and n_words[k] == len(words)


def test_small_blocks_of_pairs_change_nothing(monkeypatch):
    rows = [" ".join(["x", "y"] * 30 + ["z"] * 20), " ".join(["x", "y", "z"] * 25)]
    whole = periodic_runs.batch_runs(pa.array(rows), 12)
    monkeypatch.setattr(periodic_runs, "PAIRS", 7)
    cut = periodic_runs.batch_runs(pa.array(rows), 12)
    assert all((a == b).all() for a, b in zip(whole[:4], cut[:4])) and len(whole[0]) >= 3


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = sorted(brute_runs(words, 12), key=lambda x: (x[0], x[2]))
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    top = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
    return (len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(words, runs).encode()).hexdigest())


def digested(docs):
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = periodic_runs.digest(periodic_runs.find(periodic_runs.plant(docs)))
    return [(r["doc_id"], tuple(r[c] for c in columns)) for r in found.collect()]


def test_the_digest_matches_brute_force_with_planted_documents(spark):
    ship(spark)
    rng = random.Random(4)
    rows = [(k, t or None, "en", "s", 1, *["1"] * 7) for k, t in enumerate(texts(rng, 300))]
    rows += [(1000 + k, corpus.sentence(rng, "en", 60), "en", "s", 1, *["1"] * 7) for k in range(60)]
    got = digested(corpus.frame(spark, rows).repartition(3))
    assert sorted(got) == sorted((r[0], expected(r[0], r[1])) for r in rows)
    chosen = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1]]
    assert len(chosen) > 10 and sum(1 for i, x in got if i >= 1000 and x[0]) >= 2


def test_odd_rows_and_empty_tables(spark):
    ship(spark)
    long = " ".join(["so", "it", "goes"] * 30_000)
    rows = [*corpus.odd_rows(), (200, long, None, None, None, *[None] * 7), (201, "word " * 11, "en", "s", 1, *["1"] * 7),
            (201, "word " * 12, "en", "s", 1, *["1"] * 7)]
    got = digested(corpus.frame(spark, rows))
    key = lambda x: (x[0] is None, x[0] or 0, x[1][-1])
    short = sorted(((r[0], expected(r[0], r[1])) for r in rows if r[1] != long), key=key)
    assert sorted((g for g in got if g[0] != 200), key=key) == short
    assert next(g[1] for g in got if g[0] == 200)[:4] == (1, 0, 90_000, 3)
    none = digested(corpus.frame(spark, []))
    assert none == []


def test_the_general_operator_gives_spans_and_texts(spark):
    ship(spark)
    text = "start " + "again and " * 8 + "stop"
    got = periodic_runs.find(corpus.frame(spark, [(1, text, "en", "s", 1, *["1"] * 7)])).first()
    assert [tuple(r) for r in got["runs"]] == [(1, 16, 2)]
    assert got["collapsed"] == "start again and stop" and got["n_words"] == 18
