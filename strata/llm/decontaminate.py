"""Benchmark decontamination on a distributed positional inverted index.

*Index.* Each task turns about ``tb.CHUNK`` bytes of documents into one segment: its documents,
and for each term the sorted places where it occurs (places of different documents are
kept ``GAP`` apart, so no match crosses them). Segments are rows of a Parquet table in the
shared folder. An index made for a known benchmark keeps the postings of terms that a bitmap of
``2**VOCABULARY_BITS`` marks knows: every term of the benchmark, whatever its size, and the few others that
share a mark. Those match nothing; they only take room.

*Search.* The benchmark is the query set: it is sent out in blocks of ``BLOCK_BYTES``, each a
pass over the index, so its size is bounded in memory whatever it is. In a segment, windows with a term
that does not occur are dropped at once. For the rest, postings are visited from
the rarest term on: the places of the rarest survive while each next term occurs
near enough (proximity), and exact phrases are those whose offset-adjusted places
agree in every list.

Terms are lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII, identified by
64-bit hashes. Defined results: null has no terms; a null item_id hits words but names no item; rows that
share an item_id are one item; each document row is judged alone; an empty table gives an empty result; other
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb
from strata.llm.shared import ordered_id, plain_id, stored

WIDTH, REACH, GAP = 10, 14, 64
BLOCK_BYTES = 8 << 20
#: Marks of the vocabulary: 8 MB; ten million terms leave one other term in seven in the index.
VOCABULARY_BITS = 26

#: Bytes that end a term: all of ASCII but letters and digits.
ENDS = np.ones(256, bool)
ENDS[48:58] = ENDS[65:91] = ENDS[97:123] = False
ENDS[128:] = False

SEGMENT = "docs binary, first binary, n_words binary, terms binary, starts binary, places binary"


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = tb.words(data, offsets, ENDS)
    return tb.word_hashes(data, start, end, lower=True), first


def _mark(term: np.ndarray, bits: int) -> np.ndarray:
    return (tb.mix(term) >> np.uint64(64 - bits)).astype(np.int64)


def vocabulary_marks(blocks: Iterable[Windows], bits: int = VOCABULARY_BITS) -> np.ndarray:
    """Packed marks of the terms of all blocks."""
    marks = np.zeros(1 << bits, bool)
    for w in blocks:
        marks[_mark(w.terms, bits)] = True
    return np.packbits(marks)


def marked(term: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """False only for terms that surely are not in the vocabulary."""
    at = _mark(term, (8 * len(marks)).bit_length() - 1)
    return (marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def build_index(docs: DataFrame, vocabulary=None) -> DataFrame:
    """Segments of the positional index (not stored yet). ``vocabulary``: broadcast marks of terms, or all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches):
            term, first = _terms(*tb.buffers(batch.column("text")))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
            place = np.arange(len(term)) + doc * GAP
            if vocabulary is not None:
                keep = marked(term, vocabulary.value)
                term, place = term[keep], place[keep]
            order = np.argsort(term, kind="stable")
            term, place = term[order], place[order]
            new = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            row = (ids, first[:-1] + np.arange(batch.num_rows) * GAP, np.diff(first).astype(np.int32), term[new],
                   np.r_[new, len(term)].astype(np.int32), place.astype(np.int64 if len(first) and place.max(
                       initial=0) >= 2**31 else np.int32))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row],
                                             names=["docs", "first", "n_words", "terms", "starts", "places"])

    return docs.select(ordered_id().alias("doc_id"), "text").mapInArrow(run, SEGMENT)


class Windows:
    """A block of benchmark items as windows of term numbers."""

    def __init__(self, rows: list[tuple[str | None, str | None]], width: int = WIDTH):
        texts = pa.array([t for _, t in rows], pa.string())
        term, first = _terms(*tb.buffers(texts))
        self.terms, number = np.unique(term, return_inverse=True)
        self.number = number.astype(np.int64)
        begin, size, item = [], [], []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            n = min(width, b - a)
            if n:
                begin += range(a, b - n + 1)
                size += [n] * (b - a - n + 1)
                item += [i] * (b - a - n + 1)
        self.begin, self.size, self.item = (np.array(x, np.int64) for x in (begin, size, item))
        self.names = [name for name, _ in rows]


def _near(places: np.ndarray, others: np.ndarray, reach: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(others, places - reach), len(others) - 1)
    return np.abs(others[at] - places) <= reach


def _at(places: np.ndarray, others: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(others, places), len(others) - 1)
    return others[at] == places


def search_segment(w: Windows, terms: np.ndarray, starts: np.ndarray, places: np.ndarray,
                   reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Windows found: number, places of exact phrases, places of the rarest term in proximity matches."""
    if not len(terms) or not len(w.begin):
        return
    at = np.minimum(np.searchsorted(terms, w.terms), len(terms) - 1)
    there = terms[at] == w.terms
    count = np.where(there, starts[at + 1] - starts[at], 0)[w.number]
    # A window can match only if none of its terms is missing.
    missing = np.r_[0, np.cumsum(count == 0)]
    live = np.flatnonzero(missing[w.begin + w.size] == missing[w.begin])
    lists: dict[int, np.ndarray] = {}

    def postings(token: int) -> np.ndarray:
        t = int(w.number[token])
        if t not in lists:
            lists[t] = places[starts[at[t]]: starts[at[t] + 1]]
        return lists[t]

    for k in live.tolist():
        begin, size = int(w.begin[k]), int(w.size[k])
        rarest = (begin + np.argsort(count[begin: begin + size], kind="stable")).tolist()
        near = postings(rarest[0])
        for token in rarest[1:]:
            near = near[_near(near, postings(token), reach)]
            if not len(near):
                break
        if not len(near):
            continue
        exact = near - (rarest[0] - begin)
        for token in rarest[1:]:
            exact = exact[_at(exact + (token - begin), postings(token))]
            if not len(exact):
                break
        yield k, exact, near


FOUND = ("segment long, row int, doc_id long, n_words long, hits array<int>, items array<string>, "
         "near_items array<string>")


def _search(block, reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = block.value
        for batch in batches:
            for s in batch.to_pylist():
                docs, first = np.frombuffer(s["docs"], np.int64), np.frombuffer(s["first"], np.int64)
                n_words = np.frombuffer(s["n_words"], np.int32)
                starts = np.frombuffer(s["starts"], np.int32).astype(np.int64)
                kind = np.int32 if len(s["places"]) == 4 * starts[-1] else np.int64
                places = np.frombuffer(s["places"], kind).astype(np.int64)
                hits = [set() for _ in docs]
                items, near_items = [set() for _ in docs], [set() for _ in docs]
                for k, exact, near in search_segment(w, np.frombuffer(s["terms"], np.uint64), starts, places, reach):
                    name, size = w.names[w.item[k]], int(w.size[k])
                    for at, row in zip(exact.tolist(), (np.searchsorted(first, exact, "right") - 1).tolist(),
                                       strict=True):
                        hits[row].update(range(at - int(first[row]), at - int(first[row]) + size))
                        items[row].add(name)
                    for row in set((np.searchsorted(first, near, "right") - 1).tolist()):
                        near_items[row].add(name)
                listed = lambda sets: pa.array([sorted(x - {None}) for x in sets], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([
                    pa.array([s["segment"]] * len(docs), pa.int64()), pa.array(range(len(docs)), pa.int32()),
                    pa.array(docs), pa.array(n_words.astype(np.int64)),
                    pa.array([sorted(x) for x in hits], pa.list_(pa.int32())), listed(items), listed(near_items)],
                    names=["segment", "row", "doc_id", "n_words", "hits", "items", "near_items"])

    return run


def n_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def block_of(benchmark: DataFrame, k: int, n: int, width: int = WIDTH) -> Windows:
    """One block of the benchmark, of bounded size, on the driver."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    part = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
    return Windows([(r["item_id"], r["text"]) for r in part.collect()], width)


def find(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, reach: int = REACH,
         block_bytes: int = BLOCK_BYTES, vocabulary_bits: int = VOCABULARY_BITS) -> DataFrame:
    """One row a document: doc_id, n_words, hits (word places in exact phrases), items, near_items (sorted names)."""
    sc = docs.sparkSession.sparkContext
    n = n_blocks(benchmark, block_bytes)
    # Blocks pass the driver one at a time, first for their marks, then to be sent out.
    blocks = (block_of(benchmark, k, n, width) for k in range(n))
    marks = sc.broadcast(vocabulary_marks(blocks, vocabulary_bits))
    index = stored(build_index(docs, marks).withColumn("segment", F.monotonically_increasing_id()), "index")
    every = None
    for k in range(n):
        found = index.mapInArrow(_search(sc.broadcast(block_of(benchmark, k, n, width)), reach), FOUND)
        every = found if every is None else every.unionByName(found)
    if n == 1:
        return every.drop("segment", "row").withColumn("doc_id", plain_id("doc_id"))
    joined = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return every.groupBy("segment", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        joined("hits"), joined("items"), joined("near_items")
    ).drop("segment", "row").withColumn("doc_id", plain_id("doc_id"))


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")).cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
