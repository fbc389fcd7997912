"""Periodic runs of words, found on a grammar: a phrase that repeats back to back is detected once per rule.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
``max(min_length, 2 * q)`` words that no neighbouring word extends keeping the period.

1. *Stretches.* In a run of period q, every gram of ``ceil(min_length / 2)`` words that starts in its first
   part comes again q words on, and such grams cover the run. So runs lie inside the
   stretches that grams repeated in the same document cover; other words leave here, exactly.
2. *Re-Pair.* The word ids of a batch's stretches are compressed in rounds: in each, the pairs more
   frequent than both neighbours are replaced everywhere (equal symbols in a row pair up from
   their left), until no pair repeats; what is left is paired evenly. Equal nonterminals of
   different documents are one rule.
3. *Boundary runs.* Of each nonterminal X = A B, on one occurrence, the runs that cross the boundary: for
   each period, the shifted text is compared leftwards and rightwards from the boundary, by
   names of windows of 2, 4, 8 ... words (equal names, equal windows: nothing is left to hashes).
4. *Positions.* Rules with runs are translated to all their places, stretches that a neighbouring word
   extends (pieces of a run found whole in a longer nonterminal) are dropped, and intervals
   found with several periods keep the least. Every run crosses the boundary of the lowest
   nonterminal that holds it, so none is lost.

One pass over the documents, no shuffle; a batch holds about a MB of text, or one document.
Defined results: null or empty text has no words and no runs; rows are judged one by one, so repeated
rows repeat their result, and a null doc_id is kept; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textbatch as tb

MIN_LENGTH = 12
#: (nonterminal, period) pairs looked at together; bounds memory only.
PAIRS = 1 << 21
U = np.uint64

FOUND = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def word_ids(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words of the batch."""
    if not len(start):
        return np.zeros(0, np.int64)
    length = end - start
    offsets = np.r_[0, np.cumsum(length)]
    inside = np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])
    held = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])])
    return held.dictionary_encode().indices.to_numpy().astype(np.int64)


def repeated_stretches(ids: np.ndarray, row: np.ndarray, gram: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches that grams repeated within their row cover."""
    none = np.zeros(0, np.int64)
    n = len(ids) - gram + 1
    if n <= 0:
        return none, none
    sums = tb.prefix_sums(tb.mix(ids.astype(U) + U(1)))
    key = tb.window_hash(sums, gram) ^ tb.mix(row[:n].astype(U) * U(2) + U(1))
    whole = np.flatnonzero(row[:n] == row[gram - 1:])
    order = whole[np.argsort(key[whole], kind="stable")]
    k = key[order]
    again = np.zeros(len(k), bool)
    again[1:] = k[1:] == k[:-1]
    again[:-1] |= again[1:]
    held = tb.covered(np.sort(order[again]), gram, len(ids))
    edge = np.diff(np.r_[0, held.astype(np.int8), 0])
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # Neighbouring stretches of two rows touch where one ends and the other begins its row.
    cut = np.flatnonzero(held[1:] & held[:-1] & (row[1:] != row[:-1])) + 1
    begin, end = np.sort(np.r_[begin, cut]), np.sort(np.r_[end, cut])
    long = end - begin >= shortest
    return begin[long], end[long]


class Grammar:
    """Nonterminals of a text: where each occurs first, its boundary and end, and all its places."""

    def __init__(self) -> None:
        self.size = 0
        self.rules: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.places: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, key: np.ndarray, at: np.ndarray, left: np.ndarray, total: np.ndarray, base: int) -> np.ndarray:
        """Rules for the pairs ``key`` that begin at ``at``; returns the symbols that stand for them."""
        _, first, rule = np.unique(key, return_index=True, return_inverse=True)
        self.rules.append((at[first], at[first] + left[first], at[first] + total[first]))
        self.places.append((rule + self.size, at))
        symbol = base + self.size + rule
        self.size += len(first)
        return symbol


def _pair_keys(sym: np.ndarray) -> np.ndarray:
    """One number a pair of neighbours, equal for equal pairs; symbols are below 2**31."""
    return (sym[:-1] << 31) | sym[1:]


def _merge(sym, at, length, seg, chosen, g: Grammar, base: int):
    """Replaces the pairs that begin at ``chosen`` (none next to another)."""
    total = length[chosen] + length[chosen + 1]
    new = g.add(_pair_keys(sym)[chosen], at[chosen], length[chosen], total, base)
    keep = np.ones(len(sym), bool)
    keep[chosen + 1] = False
    sym, length = sym.copy(), length.copy()
    sym[chosen], length[chosen] = new, total
    return sym[keep], at[keep], length[keep], seg[keep]


def compress(ids: np.ndarray, seg: np.ndarray) -> Grammar:
    """Re-Pair in rounds over segments, then even pairing up to one symbol a segment."""
    g = Grammar()
    base = int(ids.max()) + 1 if len(ids) else 0
    sym, at, length = ids.copy(), np.arange(len(ids)), np.ones(len(ids), np.int64)
    while len(sym) > 1:
        together = seg[1:] == seg[:-1]
        equal = together & (sym[1:] == sym[:-1])
        # In a row of equal symbols pairs begin at its even places.
        index = np.arange(len(equal))
        begun = np.maximum.accumulate(np.where(equal & ~np.r_[False, equal[:-1]], index, 0)) if len(equal) else index
        may = together & ~(equal & ((index - begun) % 2 == 1))
        spot = np.flatnonzero(may)
        _, pair, count = np.unique(_pair_keys(sym)[spot], return_inverse=True, return_counts=True)
        if not len(count) or count.max() < 2:
            break
        order = np.lexsort((tb.mix(np.arange(len(count), dtype=U)), count))
        rank = np.empty(len(count), np.int64)
        rank[order] = np.arange(1, len(count) + 1)
        rank[count < 2] = 0
        weight = np.zeros(len(sym) + 1, np.int64)  # weight[i + 1]: of the pair at i
        weight[spot + 1] = rank[pair]
        w = weight[1:-1]
        chosen = np.flatnonzero((w > 0) & (w > weight[:-2]) & (w > weight[2:]))
        sym, at, length, seg = _merge(sym, at, length, seg, chosen, g, base)
    while len(sym) > 1:
        begins = np.r_[True, seg[1:] != seg[:-1]]
        index = np.arange(len(sym))
        offset = index - np.maximum.accumulate(np.where(begins, index, 0))
        chosen = np.flatnonzero((offset[:-1] % 2 == 0) & (seg[1:] == seg[:-1]))
        if not len(chosen):
            break
        sym, at, length, seg = _merge(sym, at, length, seg, chosen, g, base)
    return g


class Windows:
    """Names of the windows of 1, 2, 4 ... words: equal names, equal windows."""

    def __init__(self, ids: np.ndarray, longest: int) -> None:
        self.levels = [ids]
        while 2 << len(self.levels) - 1 <= longest and len(self.levels[-1]) > 1 << len(self.levels) - 1:
            half, name = 1 << len(self.levels) - 1, self.levels[-1]
            both = name[:-half] * (int(name.max()) + 1) + name[half:]
            self.levels.append(np.unique(both, return_inverse=True)[1].astype(np.int64))

    def forward(self, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j > i on, ``room`` at most."""
        return self._agree(i, j, room, 1)

    def backward(self, i: np.ndarray, j: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Words that agree before i and before j, ``room`` at most."""
        return self._agree(i, j, room, -1)

    def _agree(self, i, j, room, way):
        seen = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            size, name = 1 << k, self.levels[k]
            fits = np.flatnonzero(room - seen >= size)
            back = size if way < 0 else 0
            a, b = i[fits] + way * seen[fits] - back, j[fits] + way * seen[fits] - back
            seen[fits[name[a] == name[b]]] += size
        return seen


def boundary_runs(g: Grammar, ids: np.ndarray, min_length: int) -> tuple[np.ndarray, ...]:
    """rule, offset in it, length and period of the runs that cross a rule's boundary, cut at its ends."""
    lo, mid, hi = (np.concatenate(x) for x in zip(*g.rules, strict=True))
    rule = np.flatnonzero(hi - lo >= min_length)
    if not len(rule):
        return (np.zeros(0, np.int64),) * 4
    names = Windows(ids, int((hi - lo)[rule].max()))
    third = max(1, (-(-min_length // 2)) // 2)  # left or right of the boundary so many words agree
    grams = ids.copy()
    for k in range(1, third):
        both = grams[:-1] * (int(ids.max()) + 1) + ids[k:]
        grams = np.unique(both, return_inverse=True)[1].astype(np.int64)

    half = (hi - lo)[rule] // 2
    left, right = np.minimum((mid - lo)[rule], half), np.minimum((hi - mid)[rule], half)
    x, side, upto = np.r_[rule, rule], np.repeat([0, 1], len(rule)), np.r_[left, right]
    done = np.r_[0, np.cumsum(upto)]
    found = []
    begin = 0
    while begin < len(x):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + PAIRS, "right")) - 1)
        # All periods of the rules begin .. end - 1; a longer rule alone in slices.
        for a in range(0, int(done[end] - done[begin]), PAIRS):
            flat = np.arange(a, min(a + PAIRS, int(done[end] - done[begin]))) + done[begin]
            at = np.searchsorted(done, flat, "right") - 1
            q = flat - done[at] + 1
            r = x[at]
            i = np.where(side[at] == 0, mid[r] - q, mid[r])
            j = i + q
            after, before = hi[r] - j >= third, i - lo[r] >= third
            near = np.zeros(len(q), bool)
            near[after] = grams[i[after]] == grams[j[after]]
            near[before] |= grams[i[before] - third] == grams[j[before] - third]
            r, q, i, j = r[near], q[near], i[near], j[near]
            ahead = names.forward(i, j, hi[r] - j)
            back = names.backward(i, j, i - lo[r])
            start, size = i - back, back + ahead + q
            good = size >= np.maximum(2 * q, min_length)
            found.append((r[good], (start - lo[r])[good], size[good], q[good]))
        begin = end
    r, start, size, q = (np.concatenate(y) for y in zip(*found, strict=True))
    order = np.lexsort((q, size, start, r))
    r, start, size, q = r[order], start[order], size[order], q[order]
    least = np.r_[True, (r[1:] != r[:-1]) | (start[1:] != start[:-1]) | (size[1:] != size[:-1])] if len(r) else r > 0
    return r[least], start[least], size[least], q[least]


def segment_runs(ids: np.ndarray, seg: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of every run of a text, none across segments; sorted by start, then period."""
    none = (np.zeros(0, np.int64),) * 3
    if len(ids) < min_length:
        return none
    g = compress(ids, seg)
    if not g.rules:
        return none
    rule, offset, size, q = boundary_runs(g, ids, min_length)
    if not len(rule):
        return none
    # Places of each rule, then one row for each run of the rule at each place.
    owner, at = (np.concatenate(x) for x in zip(*g.places, strict=True))
    order = np.argsort(owner, kind="stable")
    owner, at = owner[order], at[order]
    first, last = np.searchsorted(owner, rule, "left"), np.searchsorted(owner, rule, "right")
    start, end, period = none
    many = np.r_[0, np.cumsum(last - first)]
    begin = 0
    while begin < len(rule):
        stop = max(begin + 1, int(np.searchsorted(many, many[begin] + PAIRS, "right")) - 1)
        run = np.repeat(np.arange(begin, stop), (last - first)[begin:stop])
        place = at[np.arange(len(run)) - np.repeat(many[begin:stop] - many[begin], (last - first)[begin:stop]) + first[run]]
        s = place + offset[run]
        e, p = s + size[run], q[run]
        # A neighbouring word that keeps the period extends the stretch: a piece of a longer run.
        whole = np.ones(len(s), bool)
        inner = np.flatnonzero(s > 0)
        inner = inner[seg[s[inner] - 1] == seg[s[inner]]]
        whole[inner] &= ids[s[inner] - 1] != ids[s[inner] - 1 + p[inner]]
        inner = np.flatnonzero(e < len(ids))
        inner = inner[seg[e[inner]] == seg[e[inner] - 1]]
        whole[inner] &= ids[e[inner]] != ids[e[inner] - p[inner]]
        start, end, period = np.r_[start, s[whole]], np.r_[end, e[whole]], np.r_[period, p[whole]]
        begin = stop
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    least = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else start > 0
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _collapsed(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, kept: np.ndarray,
               rows: int) -> pa.Array:
    """The kept words of each row, joined by one space."""
    start, length, row = start[kept], (end - start)[kept], row[kept]
    last = np.r_[row[1:] != row[:-1], True] if len(row) else np.zeros(0, bool)
    spaced = length + ~last  # a space after each word but the last of its row
    begins = np.r_[0, np.cumsum(spaced)]
    out = np.full(begins[-1], 0x20, np.uint8)
    inside = np.r_[0, np.cumsum(length)]
    k = np.arange(inside[-1])
    out[np.repeat(begins[:-1] - inside[:-1], length) + k] = data[np.repeat(start - inside[:-1], length) + k]
    offsets = begins[np.searchsorted(row, np.arange(rows + 1))].astype(np.int64)
    held = pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out))
    return held.cast(pa.string())


def batch_runs(texts: pa.Array, min_length: int):
    """Runs of the rows of a batch: row, start, length and period; and the rows' collapsed texts and word counts."""
    data, offsets = tb.buffers(texts)
    start, end, first = tb.words(data, offsets)
    rows = len(texts)
    row = np.repeat(np.arange(rows), np.diff(first))
    ids = word_ids(data, start, end)
    begin, stop = repeated_stretches(ids, row, -(-min_length // 2), min_length)
    size = stop - begin
    taken = np.repeat(begin - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    _, own = np.unique(ids[taken], return_inverse=True)
    s, e, q = segment_runs(own.astype(np.int64), np.repeat(np.arange(len(begin)), size), min_length)
    s, e = taken[s], taken[e - 1] + 1
    gone = np.zeros(len(ids) + 1, np.int64)
    np.add.at(gone, s + q, 1)
    np.add.at(gone, e, -1)
    kept = np.cumsum(gone[:-1]) == 0
    return row[s], s - first[row[s]], e - s, q, _collapsed(data, start, end, row, kept, rows), np.diff(first)


def _find(min_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.chunks(batches):
            row, start, size, period, collapsed, n_words = batch_runs(batch.column("text"), min_length)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(size), pa.array(period)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.ListArray.from_arrays(pa.array(offsets), found), collapsed],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def find(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and the text without the repeats, its words joined by one space.

    Of a run its first ``period`` words stay, unless another run drops them.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find(min_length), FOUND)


def _words(text: Column) -> Column:
    """Runs of other characters than space and the controls from tab to carriage return."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " ", -1), "")


def plant(docs: DataFrame) -> DataFrame:
    """``docs`` in which one document of ten turns periodic from some word on, by a hash of its doc_id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.nullif(F.size("__words"), F.lit(0))
    a, spread = g % n, 3 + g % 8
    p = 1 + F.floor((n - a) / spread)
    moved = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.get(
        "__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    return (docs.select("doc_id", "text", F.when(chosen, _words(F.col("text"))).alias("__words"))
            .select("doc_id", F.when(F.size("__words") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """The rows of ``find`` as counts, the longest run (ties: least start, then period) and hashes."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("neg"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    top = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"),
                       F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    size, period = -F.col("top.neg"), F.col("top.period")
    return top.select("doc_id", "n_runs", F.col("top.start").alias("start"), size.alias("length"), period.alias("period"),
                      F.call_function("div", 1000 * size, period).alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256", "n_words")
