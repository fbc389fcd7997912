"""Hard negatives: for each anchor and positive, the best rows of other labels in a window below the positive's score.

1. *Tiles.* Components become the integers ``floor(scale * x)``; rows are packed once into tiles of ``TILE``
   candidates and ``ANCHORS`` anchors, in the narrowest integers that hold them, and written.
2. *Cells.* The stated query set, the anchors, meets all rows in blocks: anchor tiles are dealt to groups,
   candidate tiles to others, and a task has one group of each, of about ``SIDE`` rows at most. Anchors,
   far fewer, are copied more often while that costs no more than another copy of the table.
3. *Scores.* A tile of anchors times a tile of candidates is Strassen's recursion over int64 quadrants, odd
   sides filled with zeros, down to products of ``LEAF``. Sums wrap at 64 bits, which is
   exact arithmetic modulo 2**64, so a score that fits in 64 bits is exact whatever the
   intermediate sums do. Leaves multiply in doubles where that is provably exact, else in int64.
4. *Heaps.* Each task keeps the best five positives of its anchors (score down, vec_id up), and the heaps of a
   tile merge in any order. A second round scores again and keeps, for each positive, a heap
   of the rows of other labels inside its window. Only heaps travel, never scores or pairs.

Defined results: rows with a null label or vector, or any null or non-finite component, take no part; shorter
vectors count as filled with zeros; every row is a row of its own: of repeated anchors each is mined, and
its repeats are other rows; a null vec_id sorts last and is returned as null; other columns are not
read; empty tables give empty results. Components too large for a score in 64 bits raise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import NULL_ID, stored
from strata.llm.vectors import matrix

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: Window of negative scores: from LOW to HIGH hundredths of the positive's score.
LOW, HIGH = 30, 90
ANCHORS, TILE, SIDE, SPREAD = 512, 4096, 131_072, 8192
LEAF = 32
NONE = np.iinfo(np.int64).min

TILES = "tile long, anchors boolean, n long, uid binary, ids binary, labels binary, vectors binary, kind string"
HEAPS = "tile long, scores binary, ids binary"


# --- exact products ---------------------------------------------------------------------


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact modulo 2**64; in doubles where every sum stays an integer below 2**53."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    # Python integers: the absolute value of the least int64 is none.
    top = [max(abs(int(x.max())), abs(int(x.min()))) for x in (a, b)]
    if a.shape[1] * top[0] * top[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b of int64 matrices modulo 2**64 by seven products of quadrants."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return product(a, b)
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2  # noqa: E741
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    both = strassen(a11 + a22, b11 + b22, leaf)
    lower = strassen(a21 + a22, b11, leaf)
    right = strassen(a11, b12 - b22, leaf)
    left = strassen(a22, b21 - b11, leaf)
    upper = strassen(a11 + a12, b22, leaf)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = both + left - upper + strassen(a12 - a22, b21 + b22, leaf)
    out[:i, l:] = right + upper
    out[i:, :l] = lower + left
    out[i:, l:] = both - lower + right + strassen(a21 - a11, b11 + b12, leaf)
    return out[:m, :n]


# --- heaps ------------------------------------------------------------------------------


class Heaps:
    """The ``k`` best entries of each row, best first: score down, id up. Empty places score ``NONE``."""

    def __init__(self, rows: int, k: int) -> None:
        self.score, self.id = np.full((rows, k), NONE), np.full((rows, k), NULL_ID)

    def offer(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merges entries into the heaps of their rows."""
        if not len(row):
            return
        k = self.score.shape[1]
        touched = np.unique(row)
        r = np.r_[row, np.repeat(touched, k)]
        s, i = np.r_[score, self.score[touched].reshape(-1)], np.r_[ids, self.id[touched].reshape(-1)]
        order = np.lexsort((i, ~s, r))  # ~s falls as s rises, without overflow
        r, s, i = r[order], s[order], i[order]
        place = np.arange(len(r)) - np.searchsorted(r, r, "left")
        best = place < k
        self.score[r[best], place[best]], self.id[r[best], place[best]] = s[best], i[best]

    def offer_block(self, scores: np.ndarray, may: np.ndarray, ids: np.ndarray) -> None:
        """Offers the entries of a block that ``may`` allows; those behind a row's last place are left out first."""
        worst, last = self.score[:, -1:], self.id[:, -1:]
        may = may & ((scores > worst) | ((scores == worst) & (ids < last)))
        k = self.score.shape[1]
        if scores.shape[1] > k and np.count_nonzero(may) > 8 * k * len(scores):
            least = np.partition(np.where(may, scores, NONE), scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            may &= scores >= least[:, None]
        row, column = np.nonzero(may)
        self.offer(row, scores[row, column], ids[column])


def _merge_of(k: int):
    """Of one tile: the heaps of all its tasks as one, ``k`` places each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = None
        for scores, ids in zip(pdf["scores"], pdf["ids"], strict=True):
            scores, ids = (np.frombuffer(x, np.int64).reshape(-1, k) for x in (scores, ids))
            if out is None:
                out = Heaps(len(scores), k)
            filled = np.flatnonzero(scores.reshape(-1) != NONE)
            out.offer(filled // k, scores.reshape(-1)[filled], ids.reshape(-1)[filled])
        return pd.DataFrame({"tile": pdf["tile"].iloc[:1], "scores": [out.score.tobytes()], "ids": [out.id.tobytes()]})

    return run


# --- tiles ------------------------------------------------------------------------------


def _pack(dim: int, scale: int):
    limit = int(np.sqrt((2.0 ** 63 - 1) / dim) * (1 - 1e-12))

    def narrow(x: np.ndarray) -> np.ndarray:
        for kind in ("int8", "int16", "int32"):
            if not x.size or (np.iinfo(kind).min <= x.min() and x.max() <= np.iinfo(kind).max):
                return x.astype(kind)
        return x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            x, usable = matrix(batch.column("embedding"), dim)
            usable &= ~np.asarray(batch.column("label").is_null())
            x = np.floor(scale * x[usable])
            if x.size and np.abs(x).max() > limit:
                raise ValueError(f"a component over {limit} may give a score that 64 bits do not hold")
            x = x.astype(np.int64)
            ids = batch.column("vec_id").cast(pa.int64()).fill_null(NULL_ID).to_numpy()[usable]
            labels = batch.column("label").cast(pa.int64()).fill_null(0).to_numpy()[usable]
            queries = np.asarray(batch.column("anchor").fill_null(False))[usable]
            own = uid + np.arange(len(ids))
            uid += len(ids)
            rows = []
            for which, size in ((np.arange(len(ids)), TILE), (np.flatnonzero(queries), ANCHORS)):
                for k in range(0, len(which), size):
                    w = which[k: k + size]
                    packed = narrow(x[w])
                    rows.append((int(own[w[0]]), size == ANCHORS, len(w), own[w].tobytes(), ids[w].tobytes(),
                                 labels[w].tobytes(), packed.tobytes(), packed.dtype.name))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, (
                    pa.int64(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.string()),
                    strict=True)],
                names=["tile", "anchors", "n", "uid", "ids", "labels", "vectors", "kind"])

    return run


def _long(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def _block(raw: bytes, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(raw, kind).reshape(-1, dim).astype(np.int64)


def _score(dim: int, leaf: int, positives: int, negatives: int | None, low: int, high: int):
    """Of one group of candidates and one of anchors: the anchors' heaps of positives or, if given ``negatives``, of those."""

    def windows(r) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = _long(r.pscores).reshape(-1, positives)
        q, rest = p // 100, p % 100  # no product leaves 64 bits
        return low * q - ((-low * rest) // 100), high * q + (high * rest) // 100, p != NONE

    def run(candidates: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in anchors.itertuples():
            left, labels, uid = _block(a.a_vectors, a.a_kind, dim), _long(a.a_labels), _long(a.a_uid)
            heaps = [Heaps(len(left), negatives or positives) for _ in range(positives if negatives else 1)]
            if negatives:
                least, most, there = windows(a)
            for c in candidates.itertuples():
                scores = strassen(left, _block(c.vectors, c.kind, dim).T, leaf)
                ids, same = _long(c.ids), labels[:, None] == _long(c.labels)
                if not negatives:
                    # Rows of a tile are numbered on end: an anchor itself is found by its number.
                    place = np.searchsorted(_long(c.uid), uid)
                    met = np.flatnonzero(_long(c.uid)[np.minimum(place, len(ids) - 1)] == uid)
                    same[met, place[met]] = False
                    heaps[0].offer_block(scores, same, ids)
                    continue
                for k in range(positives):
                    inside = ~same & there[:, k: k + 1] & (scores >= least[:, k: k + 1]) & (scores <= most[:, k: k + 1])
                    heaps[k].offer_block(scores, inside, ids)
            out.append((a.tile, np.stack([h.score for h in heaps], 1).tobytes(), np.stack([h.id for h in heaps], 1).tobytes()))
        return pd.DataFrame(out, columns=["tile", "scores", "ids"])

    return run


def _unpack(positives: int, negatives: int):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                scores, ids = (_long(r[c]).reshape(-1, positives, negatives) for c in ("scores", "ids"))
                a, p, k = np.nonzero(scores != NONE)
                with_null = lambda x: pa.array(x, mask=x == NULL_ID)
                yield pa.RecordBatch.from_arrays(
                    [with_null(_long(r["anchor_ids"])[a]), with_null(_long(r["pids"]).reshape(-1, positives)[a, p]),
                     pa.array((k + 1).astype(np.int32)), with_null(ids[a, p, k]),
                     pa.array(_long(r["pscores"]).reshape(-1, positives)[a, p]), pa.array(scores[a, p, k])], names=names)

    return run


def mine(vectors: DataFrame, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, leaf: int = LEAF, side: int = SIDE) -> DataFrame:
    """Hard negatives of the rows whose ``anchor`` is true; ``vectors`` has vec_id, embedding, label and anchor.

    anchor_id, positive_id, rank, negative_id, positive_score, negative_score: a row for each negative.
    """
    dim = max(1, vectors.agg(F.max(F.size("embedding"))).first()[0] or 0)
    tiles = stored(vectors.select("vec_id", "embedding", "label", "anchor").mapInArrow(_pack(dim, scale), TILES), "tiles")
    n = {r["anchors"]: r["n"] for r in tiles.groupBy("anchors").agg(F.sum("n").alias("n")).collect()}
    rows, queries = n.get(False, 0), max(1, n.get(True, 0))
    across, down = -(-queries // side), max(1, -(-rows // side), min(-(-rows // SPREAD), rows // queries))
    number = lambda k: F.pmod(F.xxhash64("tile"), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    candidates = (tiles.filter("not anchors").select("uid", "ids", "labels", "vectors", "kind", number(down).alias("row"),
                                                     every(across).alias("column")))
    anchors = tiles.filter("anchors").select("tile", *[F.col(c).alias(f"a_{c}") for c in ("uid", "ids", "labels", "vectors", "kind")])

    def heaps(left: DataFrame, width: int, score) -> DataFrame:
        cells = left.withColumn("a_column", number(across)).withColumn("a_row", every(down))
        met = candidates.groupBy("row", "column").cogroup(cells.groupBy("a_row", "a_column")).applyInPandas(score, HEAPS)
        return met.groupBy("tile").applyInPandas(_merge_of(width), HEAPS)

    best = heaps(anchors, positives, _score(dim, leaf, positives, None, low, high))
    known = stored(anchors.join(best.select("tile", F.col("scores").alias("pscores"), F.col("ids").alias("pids")), "tile"),
                   "positives")
    found = heaps(known, negatives, _score(dim, leaf, positives, negatives, low, high))
    whole = found.join(known.select("tile", F.col("a_ids").alias("anchor_ids"), "pscores", "pids"), "tile")
    return whole.select("anchor_ids", "pscores", "pids", "scores", "ids").mapInArrow(
        _unpack(positives, negatives),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def query_rows(vectors: DataFrame) -> DataFrame:
    """Every hundredth vec_id an anchor; of every seventh the label moves on by one of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"),
                          F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)).alias("anchor"))
