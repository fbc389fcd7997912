"""Near-duplicate vectors against all cosines, shards and blocks of few vectors, and odd rows."""

import numpy as np
import pytest

from strata.llm import vector_dedup as vd
from strata.llm.ship import ship

SCHEMA = "vec_id long, embedding array<float>, label int, node long, links long, top long"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 7, 7, 7)
                                  for i, v in rows], SCHEMA)


def vectors(seed, n, dim=16, hot=0.3):
    """Directions with near copies: a third around one vector, chains, exact copies."""
    rng = np.random.default_rng(seed)
    made = []
    centre = rng.normal(size=dim)
    for _ in range(n):
        roll = rng.random()
        if roll < hot:
            v = centre + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2]) * np.linalg.norm(centre) / np.sqrt(dim)
        elif made and roll < 0.6:
            v = made[rng.integers(len(made))]
            v = v * rng.choice([1, 1, 3]) + rng.normal(size=dim) * rng.choice([0, 0.1, 0.25]) * np.linalg.norm(v) / np.sqrt(dim)
        else:
            v = rng.normal(size=dim)
        made.append(np.float32(v).astype(float))
    return list(enumerate(made))


def brute(rows, cosine=0.95):
    """Links and component of each row by all cosines."""
    x = np.array([v for _, v in rows], float)
    size = np.linalg.norm(x, axis=1)
    with np.errstate(all="ignore"):
        linked = (x @ x.T) / (size[:, None] * size) >= cosine
    np.fill_diagonal(linked, False)
    least = np.array([i for i, _ in rows])
    while True:
        new = np.minimum(least, np.where(linked, least[None], 2**62).min(1))
        if (new == least).all():
            return linked, least
        least = new


def result(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def wanted(rows):
    linked, least = brute(rows)
    return {i: (int(n), int(c), i == c) for (i, _), n, c in zip(rows, linked.sum(1), least)}


def test_links_match_all_cosines_with_full_visits(spark):
    ship(spark)
    rows = vectors(1, 400)
    got = result(vd.near_vectors(frame(spark, rows).repartition(3), recall=1.0))
    linked = brute(rows)[0]
    assert sum(v[0] for v in got.values()) >= 0.99 * linked.sum() > 1000
    exact = wanted(rows)
    assert all(got[i][0] <= exact[i][0] for i in got)  # none below the limit
    assert sum(got[i] == exact[i] for i in got) >= 0.97 * len(got)


def test_small_shards_and_blocks_give_the_same_rows(spark, monkeypatch):
    ship(spark)
    rows = vectors(2, 300)
    whole = result(vd.near_vectors(frame(spark, rows).repartition(2)))
    # Cells are larger than a shard of 16, and shards have many blocks of visitors.
    monkeypatch.setattr(vd, "QUEUE", 1)
    cut = result(vd.near_vectors(frame(spark, rows).repartition(2), shard=16))
    assert cut == whole and max(v[0] for v in whole.values()) > 32


@pytest.mark.parametrize("cosine", [0.95, 0.9])
def test_every_kind_of_planted_pair_is_visited(cosine):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32))
    grid = vd.fit(x, 20_000, cosine, 0.99)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    for a, b in vd._planted(unit, rng, cosine):
        row, cell, own_a = grid.traverse(a)
        other = grid.bounds(b)[2]
        met = np.zeros(len(a), bool)
        met[row[cell == other[row]]] = True
        back_row, back_cell, _ = grid.traverse(b)
        back = np.zeros(len(a), bool)
        back[back_row[back_cell == own_a[back_row]]] = True
        assert np.where(own_a >= other, met, back).mean() > 0.97
    assert len(row) < 0.5 * len(a) * grid.shape[0] * grid.shape[1]


def test_traversal_takes_cells_in_the_order_of_their_sums():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 8))
    grid = vd.fit(x, 4000, 0.9, 0.99)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    row, cell, _ = grid.traverse(unit)
    a, b, _ = grid.bounds(unit)
    cost = a[row, cell // grid.shape[1]] + b[row, cell % grid.shape[1]]
    for r in range(0, 500, 50):
        mine = cost[row == r]
        assert (np.diff(mine) >= 0).all()
        assert len(mine) == ((a[r][:, None] + b[r]) <= grid.limit).sum() == len(set(cell[row == r]))


def test_odd_rows_and_empty_tables(spark):
    ship(spark)
    rng = np.random.default_rng(7)
    v, w, u = (rng.normal(size=4) for _ in range(3))
    rows = [(1, v), (2, 2 * v), (2, w), (3, None), (4, [0, 0, 0, 0]), (5, [1, None, 2, 3]), (6, [float("nan")] * 4),
            (7, [float("inf"), 1, 1, 1]), (None, v), (None, u), (8, []), (9, [1.0]), (10, [1.0, 0.0]), (11, w)]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"])
                  for r in vd.near_vectors(frame(spark, rows)).collect()), key=str)
    assert got == sorted([
        (1, 2, 1, True), (2, 2, 1, False), (2, 1, 2, True), (11, 1, 2, False), (None, 2, 1, False), (None, 0, None, True),
        (9, 1, 9, True), (10, 1, 9, False), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)]], key=str)
    assert vd.near_vectors(frame(spark, [])).collect() == []
    assert result(vd.near_vectors(frame(spark, [(1, None), (2, [0.0])]))) == {1: (0, 1, True), 2: (0, 2, True)}
    assert vd.near_vectors(frame(spark, rows)).columns == ["vec_id", "n_links", "component_id", "kept"]


def test_one_vector_many_times_is_one_node_a_batch(spark):
    ship(spark)
    v = np.random.default_rng(8).normal(size=8)
    rows = [(i, v) for i in range(3000)]
    df = frame(spark, rows).repartition(2)
    assert vd.nodes(df)[0].count() == 2
    assert result(vd.near_vectors(df)) == {i: (2999, 0, i == 0) for i in range(3000)}
