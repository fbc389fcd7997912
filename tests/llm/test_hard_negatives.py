"""Hard negatives against all scores in Python integers, Strassen against plain products, heaps, and odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as hn
from strata.llm.ship import ship

SCHEMA = "vec_id long, embedding array<float>, label int, tile long, scores string, uid int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, "x", 1)
                                  for i, v, label in rows], SCHEMA)


def order(i):
    return hn.NULL_ID if i is None else i


def brute(rows, positives=5, negatives=10):
    """Every score of every anchor in Python integers."""
    held = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        held.append((k, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for k, i, q, label in held:
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, other)), order(j), n, lab) for n, j, other, lab in held if n != k))
        best = [(-s, j) for s, j, _, lab in scored if lab == label][:positives]
        for ps, p in best:
            inside = [(-s, j) for s, j, _, lab in scored if lab != label and 30 * ps <= -100 * s <= 90 * ps][:negatives]
            out += [(i, p, r + 1, j, ps, s) for r, (s, j) in enumerate(inside)]
    return sorted(out)


def mined(df, **how):
    rows = hn.mine(hn.query_rows(df), **how).collect()
    return sorted((r["anchor_id"], order(r["positive_id"]), r["rank"], order(r["negative_id"]), r["positive_score"],
                   r["negative_score"]) for r in rows)


def vectors(seed, n, labels=4, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim)) * 0.4
    hot = rng.normal(size=dim) * 0.3
    made = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = hot if rng.random() < 0.33 else centres[label] * 0.5 + hot * 0.4 + rng.normal(size=dim) * 0.2
        made.append((i * 5, v.tolist(), label))
    return made


@pytest.mark.parametrize("shape", [(1, 1, 1), (2, 2, 2), (5, 7, 3), (16, 16, 16), (33, 12, 65), (0, 3, 4), (40, 64, 90)])
@pytest.mark.parametrize("top", [5, 2**31, 2**62])
def test_strassen_is_exact_modulo_two_to_the_64(shape, top):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-top, top, (m, k)), rng.integers(-top, top, (k, n))
    want = [[sum(int(a[i, x]) * int(b[x, j]) for x in range(k)) for j in range(n)] for i in range(m)]
    want = np.array([[(w + 2**63) % 2**64 - 2**63 for w in row] for row in want], np.int64).reshape(m, n)
    for leaf in (1, 2, 8):
        assert (hn.strassen(a, b, leaf) == want).all()


def test_heaps_merge_in_any_order_and_keep_ties_by_id():
    rng = np.random.default_rng(1)
    entries = [(int(rng.integers(6)), int(rng.integers(-4, 4)), int(i)) for i in range(400)]
    want = [sorted([(-s, i) for r, s, i in entries if r == row])[:5] for row in range(6)]
    for _ in range(5):
        heaps, deal = hn.Heaps(6, 5), rng.permutation(400)
        for part in np.array_split(deal, 7):
            heaps.offer(*(np.array([entries[x][c] for x in part]) for c in range(3)))
        assert [[(-int(s), int(i)) for s, i in zip(*x)] for x in zip(heaps.score, heaps.id)] == want
    block = hn.Heaps(2, 3)
    block.offer_block(np.ones((2, 500), np.int64), np.ones((2, 500), bool), np.arange(500)[::-1])
    assert block.id.tolist() == [[0, 1, 2]] * 2


def test_rows_match_brute_force(spark):
    ship(spark)
    rows = vectors(3, 500)
    want = brute(rows)
    assert len(want) > 500 and mined(frame(spark, rows).repartition(3)) == want


def test_many_small_cells_tiles_and_leaves_give_the_same_rows(spark, monkeypatch):
    ship(spark)
    rows = vectors(4, 240)
    df = frame(spark, rows).repartition(5)
    for name, value in (("TILE", 16), ("ANCHORS", 2), ("SPREAD", 10)):
        monkeypatch.setattr(hn, name, value)
    assert mined(df, side=5, leaf=2) == brute(rows) != []


def test_odd_rows_and_empty_tables(spark):
    ship(spark)
    v = [0.5, 0.25, -0.5, 1.0]
    w = [0.4, 0.2, -0.3, 0.6]
    rows = [(100, v, 1), (100, v, 1), (100, w, 1), (200, v, None), (300, None, 1), (400, [None, 1, 1, 1], 1),
            (500, [float("nan"), 1, 1, 1], 1), (600, [float("inf"), 1, 1, 1], 2), (None, v, 1), (None, w, 2), (3, w, 2), (3, w, 2),
            (4, [0.3, 0.2], 2), (5, [], 2), (7, w, 0), (800, [-1.0, -1.0, -1.0, -1.0], 5)]
    got = mined(frame(spark, rows))
    assert got == brute([(i, v if v is None or None in v else [*v, *[0.0] * (4 - len(v))], x) for i, v, x in rows]) != []
    assert mined(frame(spark, [])) == [] == mined(frame(spark, [(1, v, 1), (100, None, 1)])) == mined(frame(spark, [(100, v, 1)]))
    assert set(hn.mine(hn.query_rows(frame(spark, rows))).columns) == {
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"}


def test_scores_near_64_bits_are_exact_and_greater_ones_raise(spark):
    ship(spark)
    big = 2.0**22  # times 256, squared, twice: 2**61
    rows = [(100, [big, big], 1), (1, [big, big / 2], 1), (2, [big, 0.0], 2), (3, [0.0, big / 2], 2)]
    df = frame(spark, rows)
    assert mined(df) == brute(rows) != []
    with pytest.raises(Exception, match="64 bits"):
        mined(frame(spark, [(100, [2.0**40], 1), (1, [1.0], 1)]))


def test_the_general_operator_takes_any_anchors_and_sizes(spark):
    ship(spark)
    rows = vectors(5, 60)
    df = frame(spark, rows).withColumn("anchor", F.col("vec_id") == 5)
    got = hn.mine(df, positives=1, negatives=2, low=0, high=100).collect()
    assert {r["anchor_id"] for r in got} == {5} and {r["rank"] for r in got} <= {1, 2}
    assert len({r["positive_id"] for r in got}) == 1
