"""Near-duplicate embeddings by an inverted multi-index.

1. *Nodes.* Equal vectors of an Arrow batch are one node with its rows' ids and their number, so a vector that
   a third of all rows hold is one row a batch. Nodes are written once; everything below uses them.
2. *Grid.* Two codebooks, trained apart on the vectors' halves (k-means on at most ``SAMPLE`` nodes chosen by
   hash), cut the space into the cells of their product. Every node is posted in its cell.
3. *Traversal.* How far a vector must move before its half falls to another codeword is the distance
   to the plane between that codeword and its own; the squares of both halves add up. Multi-sequence
   traversal takes cells in the order of that sum from two sorted lists, and stops at the
   sum that reaches ``RECALL`` of planted pairs at the similarity limit (noise of
   several kinds, each kind must reach it); links above the limit lie nearer. A vector visits the
   cells before its own in the grid's order, so a pair is met once.
4. *Shards.* Cells in grid order make shards of up to ``SHARD`` members; a larger cell is
   dealt to several. A vector travels once to each shard it visits; a shard that many visit is
   copied for blocks of ``QUEUE * SHARD`` visitors. A task verifies cell by cell with cosines in double
   precision, counts links for both ends and joins what it linked to local components: it emits a row
   a vector, never a pair. All pairs of visited cells are verified; there is no cap.
5. Components by star contraction (``components.py``) over those rows.

The driver holds codebooks, the nodes of each cell (at most ``CODEWORDS ** 2`` numbers) and the
visitors of each shard (a number for ``SHARD`` nodes).

Defined results: vectors that are null, zero, or hold null or non-finite components link with nothing and keep
themselves; shorter vectors count as filled with zeros; each row is a vector of its own, also
where vec_ids repeat; a null vec_id sorts last and is kept if its component has no other;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import components
from strata.llm.shared import NULL_ID, stored
from strata.llm.vectors import matrix

COSINE, RECALL = 0.95, 0.99
SAMPLE, CODEWORDS, PER_CELL, ROUNDS = 16_384, 1024, 8, 8
SHARD, QUEUE = 8192, 4
#: Cosines held, and vectors traversed, at a time by a task.
BLOCK, ROWS = 1 << 21, 1024

NODES = "node long, least long, n long, ids array<long>, vector binary"
FOUND = "node long, least long, links long, root_least long, root long"


# --- nodes ------------------------------------------------------------------------------


def _collapse(dim: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            x, usable = matrix(batch.column("embedding"), dim)
            ids = batch.column("vec_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy()
            usable &= (x != 0).any(axis=1)
            raw = np.ascontiguousarray(x.astype(kind))
            # Unusable rows are nodes of their own, without a vector.
            rows = np.flatnonzero(usable)
            _, same = np.unique(raw[rows].view(f"V{max(1, raw.shape[1] * raw.itemsize)}").reshape(-1), return_inverse=True)
            group = np.empty(len(ids), np.int64)
            group[rows] = same
            distinct = int(same.max()) + 1 if len(rows) else 0
            group[~usable] = distinct + np.arange(len(ids) - len(rows))
            order = np.lexsort((ids, group))
            group, ids = group[order], ids[order]
            begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else group
            ends = np.r_[begin, len(group)].astype(np.int32)
            vectors = [raw[order[b]].tobytes() if k < distinct else None for k, b in enumerate(begin.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(task + seen + np.arange(len(begin))), pa.array(ids[begin]), pa.array(np.diff(ends).astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(vectors, pa.binary())],
                names=["node", "least", "n", "ids", "vector"])
            seen += len(begin)

    return run


def nodes(vectors: DataFrame) -> tuple[DataFrame, int, str]:
    """Written nodes, the number of components and their type."""
    kind = "f4" if "float" in vectors.schema["embedding"].dataType.simpleString() else "f8"
    dim = max(1, vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)
    return stored(vectors.select("vec_id", "embedding").mapInArrow(_collapse(dim, kind), NODES), "nodes"), dim, kind


# --- grid -------------------------------------------------------------------------------


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances to every codeword, but for each row's own constant."""
    return (words ** 2).sum(1) - 2 * (x @ words.T)


def codebook(x: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; codewords in a chain of near neighbours, so that near ones have near numbers."""
    distinct = np.unique(x, axis=0)
    words = distinct[rng.choice(len(distinct), min(size, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        own = _nearest(x, words).argmin(1)
        n = np.bincount(own, minlength=len(words))
        for k in range(x.shape[1]):
            moved = np.bincount(own, x[:, k], len(words))
            words[:, k] = np.where(n > 0, moved / np.maximum(n, 1), words[:, k])
    left, chain = np.ones(len(words), bool), [0]
    left[0] = False
    while left.any():
        d = np.where(left, _nearest(words[chain[-1]][None], words)[0], np.inf)
        chain.append(int(d.argmin()))
        left[chain[-1]] = False
    return words[chain]


class Grid:
    """Two codebooks, how far traversal goes, and the shards of the cells."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        self.words = (first, second)
        self.apart = []
        for words in self.words:
            square = (words ** 2).sum(1)
            gap = 2 * np.sqrt(np.maximum(square[:, None] + square - 2 * (words @ words.T), 0))
            # Equal codewords are no step apart; an infinite divisor makes the step cost nothing.
            self.apart.append(np.where(gap > 1e-6, gap, np.inf).astype(np.float32))
        self.half, self.shape = first.shape[1], (len(first), len(second))
        self.limit = 0.0

    def bounds(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For both halves, squares of how far each vector is from falling to each codeword; and its cell."""
        cost, own = [], []
        for words, apart, x in zip(self.words, self.apart, (unit[:, :self.half], unit[:, self.half:]), strict=True):
            d = _nearest(x, words)
            near = d.argmin(1)
            cost.append(((d - d[np.arange(len(d)), near][:, None]) / apart[near]) ** 2)
            own.append(near)
        return cost[0], cost[1], own[0] * self.shape[1] + own[1]

    def traverse(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Visits (vector, cell), nearest cells first, and each vector's own cell.

        Two sorted lists of costs; each row of the first list keeps the next place in the second,
        and the least sum of all vectors' open rows is taken in step.
        """
        a, b, own = self.bounds(unit)
        ra, rb = np.argsort(a, 1, kind="stable"), np.argsort(b, 1, kind="stable")
        a, b = np.take_along_axis(a, ra, 1), np.take_along_axis(b, rb, 1)
        wide = max(1, int((a <= self.limit).sum(1).max(initial=0)))
        a = a[:, :wide]
        b = np.c_[b, np.full(len(b), np.inf)]
        place = np.zeros(a.shape, np.int64)
        sums = a + b[:, :1]
        live, rows, cells = np.arange(len(unit)), [], []
        while len(live):
            k = sums[live].argmin(1)
            go = sums[live, k] <= self.limit
            live, k = live[go], k[go]
            j = place[live, k]
            rows.append(live)
            cells.append(ra[live, k] * self.shape[1] + rb[live, j])
            place[live, k] = j + 1
            sums[live, k] = a[live, k] + b[live, j + 1]
        if not rows:
            return own[:0], own[:0], own
        return np.concatenate(rows), np.concatenate(cells), own


def _planted(unit: np.ndarray, rng: np.random.Generator, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs at the limit: even noise, the direction of another vector, and that in either half alone."""
    other = unit[rng.permutation(len(unit))]
    half = (unit.shape[1] + 1) // 2
    front, back = other.copy(), other.copy()
    front[:, half:] = 0
    back[:, :half] = 0
    for noise in (rng.normal(size=unit.shape), other, front, back):
        z = noise - (noise * unit).sum(1)[:, None] * unit
        size = np.linalg.norm(z, axis=1)
        good = size > 0.1 * np.maximum(np.linalg.norm(noise, axis=1), 1e-9)
        z, x = z[good] / size[good][:, None], unit[good]
        if len(x):
            yield x, cosine * x + np.sqrt(max(0.0, 1 - cosine ** 2)) * z


def fit(sample: np.ndarray, n: int, cosine: float, recall: float) -> Grid:
    """Codebooks for ``n`` vectors, and the limit at which each kind of planted pairs reaches ``recall``."""
    rng = np.random.Generator(np.random.PCG64(29))
    unit = sample / np.linalg.norm(sample, axis=1)[:, None]
    half = (unit.shape[1] + 1) // 2
    size = int(min(CODEWORDS, max(2, round(np.sqrt(n / PER_CELL)))))
    grid = Grid(codebook(unit[:, :half].copy(), size, rng), codebook(unit[:, half:].copy(), size, rng))
    for x, y in _planted(unit[rng.permutation(len(unit))[:4096]], rng, cosine):
        ax, bx, cx = grid.bounds(x)
        ay, by, cy = grid.bounds(y)
        k, c = np.arange(len(x)), grid.shape[1]
        cost = np.where(cx >= cy, ax[k, cy // c] + bx[k, cy % c], ay[k, cx // c] + by[k, cx % c])
        grid.limit = max(grid.limit, float(np.quantile(cost, recall, method="higher")))
    grid.limit = min(grid.limit, 2 - 2 * cosine)  # beyond that no pair can lie
    return grid


class Deal:
    """Shards of the cells in grid order, and the blocks of visitors of each shard."""

    def __init__(self, cells: np.ndarray, n: np.ndarray, total: int, shard: int) -> None:
        self.first, self.parts = np.zeros(total, np.int64), np.zeros(total, np.int64)
        at, held = 0, 0
        for cell, k in zip(cells.tolist(), n.tolist(), strict=True):
            if held and held + k > shard:
                at, held = at + 1, 0
            parts = -(-k // shard)
            self.first[cell], self.parts[cell] = at, parts
            held += k
            if parts > 1:
                at, held = at + parts, 0
        self.shards = at + 1
        self.blocks = np.ones(self.shards, np.int64)

    def home(self, cell: np.ndarray, node: np.ndarray) -> np.ndarray:
        return self.first[cell] + _spread(node) % np.maximum(self.parts[cell], 1)

    def visits(self, row: np.ndarray, cell: np.ndarray, own: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (vector, shard) of the cells before a vector's own, its own shard left out."""
        ahead = (cell < own[row]) & (self.parts[cell] > 0)
        row, cell = row[ahead], cell[ahead]
        # The other parts of a large cell that come first count as cells before.
        split = np.flatnonzero(home > self.first[own])
        row = np.r_[row, split]
        begin = np.r_[self.first[cell], self.first[own[split]]]
        many = np.r_[self.parts[cell], home[split] - self.first[own[split]]]
        row = np.repeat(row, many)
        shard = np.repeat(begin - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        key = np.unique(row * self.shards + shard)
        row, shard = key // self.shards, key % self.shards
        away = shard != home[row]
        return row[away], shard[away]


def _spread(node: np.ndarray) -> np.ndarray:
    x = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(33)).astype(np.int64)


def _vectors(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1)[:, None]


def _count_cells(grid: Grid, dim: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = grid.bounds(_unit(_vectors(batch.column("vector"), dim, kind)))[2]
            found, n = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["key", "n"])

    return run


def _slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _count_visits(grid: Grid, deal: Deal, dim: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            row, cell, own = grid.traverse(_unit(_vectors(batch.column("vector"), dim, kind)))
            home = deal.home(own, batch.column("node").to_numpy())
            found, n = np.unique(deal.visits(row, cell, own, home)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["key", "n"])

    return run


# --- shipping and verification ----------------------------------------------------------

SENT = "shard long, block long, visits boolean, node binary, least binary, n binary, vector binary"


def _send(grid: Grid, deal: Deal, dim: int, kind: str):
    """Members to every block of their shard, visitors to one block of each shard they visit; packed by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            raw = np.frombuffer(b"".join(batch.column("vector").to_pylist()), kind).reshape(-1, dim)
            node, least, n = (batch.column(c).to_numpy() for c in ("node", "least", "n"))
            row, cell, own = grid.traverse(_unit(raw.astype(np.float64)))
            home = deal.home(own, node)
            row, shard = deal.visits(row, cell, own, home)
            many = deal.blocks[home]
            members = np.repeat(np.arange(len(node)), many)
            to = np.r_[np.repeat(home, many), shard]
            block = np.r_[np.arange(len(members)) - np.repeat(np.cumsum(many) - many, many),
                          _spread(node[row] ^ shard) % deal.blocks[shard]]
            visits = np.r_[np.zeros(len(members), bool), np.ones(len(row), bool)]
            who = np.r_[members, row]
            order = np.lexsort((visits, block, to))
            to, block, visits, who = to[order], block[order], visits[order], who[order]
            cut = np.flatnonzero(np.r_[True, (to[1:] != to[:-1]) | (block[1:] != block[:-1]) | (visits[1:] != visits[:-1])])
            ends = np.r_[cut[1:], len(to)]
            packs = [who[i:j] for i, j in zip(cut.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(to[cut]), pa.array(block[cut]), pa.array(visits[cut]), pa.array([node[p].tobytes() for p in packs]),
                 pa.array([least[p].tobytes() for p in packs]), pa.array([n[p].tobytes() for p in packs]),
                 pa.array([raw[p].tobytes() for p in packs])],
                names=["shard", "block", "visits", "node", "least", "n", "vector"])

    return run


class Forest:
    """Components of local numbers; the root is the least of each."""

    def __init__(self, size: int) -> None:
        self.parent = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.parent[a], self.parent[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.parent[self.parent]
                if (up == self.parent).all():
                    break
                self.parent = up


def _verify(grid: Grid, dim: int, kind: str, cosine: float):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [pdf[~pdf["visits"]], pdf[pdf["visits"]]]
        node, least, n = (np.frombuffer(b"".join(p for part in parts for p in part[c]), np.int64) for c in ("node", "least", "n"))
        raw = np.frombuffer(b"".join(p for part in parts for p in part["vector"]), kind).reshape(-1, dim)
        size = sum(len(p) for p in parts[0]["node"]) // 8
        order = np.lexsort((node, least))  # local numbers in the order of (least, node)
        member = order < size
        node, least, n, x = node[order], least[order], n[order], raw[order].astype(np.float64)
        norm = np.linalg.norm(x, axis=1)
        unit = x / norm[:, None]
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        visit, to, own = [], [], np.empty(len(node), np.int64)
        for k in range(0, len(node), ROWS):
            row, cell, mine = grid.traverse(unit[k: k + ROWS])
            own[k: k + ROWS] = mine
            ahead = cell < mine[row]
            visit.append(row[ahead] + k)
            to.append(cell[ahead])
        visit, to = (np.concatenate(v) if v else own[:0] for v in (visit, to))
        inside = np.flatnonzero(member)
        inside = inside[np.argsort(own[inside], kind="stable")]
        cells, begin = np.unique(own[inside], return_index=True)
        ends = np.r_[begin[1:], len(inside)]
        # Visitors of cells that lie here; members are visitors too, in the first block of a shard only.
        mine = np.isin(to, cells) & (~member[visit] if key[1] else True)
        visit, to = visit[mine], to[mine]
        # Other parts of a large cell.
        same = np.flatnonzero(~member & np.isin(own, cells))
        visit, to = np.r_[visit, same], np.r_[to, own[same]]
        grouped = np.argsort(to, kind="stable")
        visit, to = visit[grouped], to[grouped]

        def compare(left: np.ndarray, right: np.ndarray, triangle: bool) -> None:
            step = max(1, BLOCK // max(1, len(right)))
            for k in range(0, len(left), step):
                rows = left[k: k + step]
                linked = (x[rows] @ x[right].T) / (norm[rows][:, None] * norm[right]) >= cosine
                if triangle:
                    linked &= np.arange(k, k + len(rows))[:, None] < np.arange(len(right))
                i, j = np.nonzero(linked)
                if len(i):
                    np.add.at(links, rows[i], n[right[j]])
                    np.add.at(links, right[j], n[rows[i]])
                    forest.join(rows[i], right[j])

        for cell, i, j in zip(cells.tolist(), begin.tolist(), ends.tolist(), strict=True):
            held = inside[i:j]
            guests = visit[np.searchsorted(to, cell, "left"): np.searchsorted(to, cell, "right")]
            compare(guests, held, False)
            if not key[1]:
                compare(held, held, True)
        found = links > 0
        root = forest.parent[found]
        return pd.DataFrame({"node": node[found], "least": least[found], "links": links[found],
                             "root_least": least[root], "root": node[root]})

    return run


def _counted(rows: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in rows.groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[r["key"]] = r["n"]
    return out


def links(found: DataFrame, dim: int, kind: str, cosine: float = COSINE, recall: float = RECALL,
          shard: int = SHARD) -> DataFrame | None:
    """Of written nodes: for each node and task, links there and the least (least, node) it is tied to; None without vectors."""
    live = found.filter("vector is not null").select("node", "least", "n", "vector")
    many = live.count()
    if not many:
        return None
    # About SAMPLE nodes by hash; a margin, so that the bound is met and seldom missed.
    share = min(1.0, 1.2 * SAMPLE / many)
    by = F.xxhash64("node")
    chosen = live.filter(F.pmod(by, F.lit(1 << 30)) < int(share * (1 << 30)) + 1).orderBy(by).limit(SAMPLE)
    sample = np.frombuffer(b"".join(bytes(r["vector"]) for r in chosen.select("vector").collect()), kind).reshape(-1, dim)
    grid = fit(sample.astype(np.float64), many, cosine, recall)
    total = grid.shape[0] * grid.shape[1]
    n = _counted(live.select("vector").mapInArrow(_count_cells(grid, dim, kind), "key long, n long"), total)
    cells = np.flatnonzero(n)
    deal = Deal(cells, n[cells], total, shard)
    visits = _counted(live.select("node", "vector").mapInArrow(_count_visits(grid, deal, dim, kind), "key long, n long"),
                      deal.shards)
    deal.blocks = np.maximum(1, -(-visits // (QUEUE * shard)))
    sent = live.mapInArrow(_send(grid, deal, dim, kind), SENT)
    return stored(sent.groupBy("shard", "block").applyInPandas(_verify(grid, dim, kind, cosine), FOUND), "vector-links")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (least vec_id reachable), kept: a row for each vector."""
    found, dim, kind = nodes(vectors)
    tied = links(found, dim, kind, cosine, recall, shard)
    base = found.select("node", "least", "n", "ids", F.col("vector").isNotNull().alias("usable"))
    rows = base.withColumn("links", F.lit(0).cast("long")).withColumn("top", F.col("least"))
    if tied is not None:
        total = tied.groupBy("node").agg(F.sum("links").alias("links"))
        ends = components(tied.select(F.struct(F.col("least").alias("x"), F.col("node").alias("y")).alias("a"),
                                      F.struct(F.col("root_least").alias("x"), F.col("root").alias("y")).alias("b")))
        reached = ends.select(F.col("node.y").alias("node"), F.col("component.x").alias("top"))
        rows = (base.join(total, "node", "left").join(reached, "node", "left")
                .withColumn("links", F.coalesce("links", F.lit(0)).cast("long")).withColumn("top", F.coalesce("top", "least")))
    given = lambda c: F.when(c != NULL_ID, c)
    one = rows.select(F.explode("ids").alias("id"), "top", (F.col("links") + F.when(F.col("usable"), F.col("n") - 1)
                                                            .otherwise(0)).alias("n_links"))
    return one.select(given(F.col("id")).alias("vec_id"), "n_links", given(F.col("top")).alias("component_id"),
                      (F.col("id") == F.col("top")).alias("kept"))
