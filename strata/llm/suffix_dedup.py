"""Suffix-array dedup of repeated byte strings, sorted by the deep-shallow method.

Texts are UTF-8 bytes; a byte goes when a string of ``length`` bytes that covers it also
starts anywhere else, in another document or further along the same one.

1. *Anchors.* Every ``length``-byte string elects the leftmost of its least ``gram``-byte
   sub-strings, so equal strings elect equal anchors at equal offsets. The strings that
   elect one anchor are neighbours; together with it they form a short context of
   under two lengths. A merged, bounded count-min sketch drops anchors that surely occur once.
2. *Sparse suffix array.* Contexts go to buckets by anchor. A bucket sorts the suffixes
   that start at its anchors and, read backwards, what stands before them:
   multikey quicksort on eight-byte characters down to ``SHALLOW`` bytes, then blind tries
   for groups that still agree. From both orders and their common-prefix lengths,
   two strings at one offset are equal exactly when they share a class on both sides.
   Equal contexts are combined in the task that cuts them, so that a text copied a
   million times reaches its bucket once for each batch, not a million times.
3. Runs of repeated starts go back to their documents, where bytes are cut.

Defined results: null is empty; each row is a document of its own, also where rows share a doc_id or have
none; extra columns are ignored; texts over ``SEGMENT`` bytes are cut in overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import packed, sketch
from strata.llm import textbatch as tb
from strata.llm.shared import identified, ordered_id, partitions

LENGTH, GRAM, SHALLOW, SMALL, SEGMENT = 400, 64, 64, 16, 1 << 22


# ---- deep-shallow sorting -------------------------------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (x.bit_length() + 7 >> 3)


def blind_trie(texts: list[bytes], group: list[int]) -> list[int]:
    """The group in order. Nodes hold only the place where their children part and the byte there.

    An insertion walks down looking at those bytes alone, compares its text once with
    the leaf it meets, then parts the path at the first difference.
    """
    root: list = [-1, [group[0]]]  # leaf: [-1, equal texts]; node: [place, {byte or -1: child}]
    for i in group[1:]:
        text = texts[i]
        n = len(text)
        node = root
        while node[0] >= 0:
            child = node[1].get(text[node[0]] if node[0] < n else -1)
            node = child if child is not None else next(iter(node[1].values()))
        other = texts[node[1][0]]
        same = common(text, other)
        if same == n == len(other):
            node[1].append(i)
            continue
        byte = text[same] if same < n else -1
        node = root
        while 0 <= node[0] < same:
            node = node[1][text[node[0]]]
        if node[0] == same:
            node[1][byte] = [-1, [i]]
        else:
            node[:] = [same, {other[same] if same < len(other) else -1: node[:], byte: [-1, [i]]}]
    out: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if node[0] < 0:
            out += node[1]
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow(texts: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the texts, and the common prefix of each with the one before it in that order."""
    n = len(texts)
    wide = np.frombuffer(b"".join(t[:shallow].ljust(shallow, b"\0") for t in texts), ">u8").astype(np.uint64)
    wide = wide.reshape(n, shallow // 8)
    order: list[int] = []
    stack = [(np.arange(n), 0)] if n else []
    while stack:
        group, depth = stack.pop()
        if len(group) <= SMALL or depth == wide.shape[1]:
            order += blind_trie(texts, group.tolist()) if len(group) > 1 else group.tolist()
            continue
        key = wide[group, depth]
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        less, more = key < pivot, key > pivot
        for part, at in ((group[more], depth), (group[~(less | more)], depth + 1), (group[less], depth)):
            if len(part):
                stack.append((part, at))
    lcp = np.zeros(n, np.int64)
    for k in range(1, n):
        lcp[k] = common(texts[order[k - 1]], texts[order[k]])
    return np.array(order, np.int64), lcp


# ---- contexts -------------------------------------------------------------------------

def _segments(batches: Iterator[pa.RecordBatch], length: int):
    """Bytes, row offsets, row ids and the place of each row's first byte in its text."""
    for batch in tb.chunks(batches):
        data, offsets = tb.buffers(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        if len(data) <= 2 * SEGMENT:
            yield data, offsets, ids, np.zeros(len(ids), np.int64)
            continue
        for i in range(len(ids)):
            text = data[offsets[i]: offsets[i + 1]]
            for at in range(0, max(1, len(text) - length + 1), SEGMENT):
                part = text[at: at + SEGMENT + length - 1]
                yield part, np.array([0, len(part)]), ids[i: i + 1], np.array([at])


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Anchor place, first and last start that elects it, and its hash; for all rows."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, np.uint64)
    keys = tb.window_hash(tb.prefix_sums(tb.BYTE_VALUE[data]), gram)
    elected = tb.sliding_argmin(keys, length - gram + 1)
    valid = np.zeros(len(data) + 1, np.int8)
    begin, end = offsets[:-1], offsets[1:] - length + 1
    long = end > begin
    np.add.at(valid, begin[long], 1)
    np.add.at(valid, end[long], -1)
    starts = np.flatnonzero(np.cumsum(valid[: len(elected)]) > 0)
    if not len(starts):
        return none, none, none, np.zeros(0, np.uint64)
    elected = elected[starts]
    new = np.r_[True, (elected[1:] != elected[:-1]) | (starts[1:] != starts[:-1] + 1)]
    # A new row begins a new run even where its first start follows the last one directly.
    row = np.searchsorted(offsets, starts, "right") - 1
    new[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(starts)] - 1
    return elected[first], starts[first], starts[last], keys[elected[first]]


def _keys(length: int, gram: int):
    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for data, offsets, _, _ in _segments(batches, length):
            yield _anchors(data, offsets, length, gram)[3]

    return keys_of


CONTEXT = "bucket int, known boolean, text binary, lengths binary, anchors binary, doc binary, start binary, stop binary"
HELD = 1 << 24


def _contexts(length: int, gram: int, sketched, bits: int, buckets: int):
    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        new: dict[int, list] = {}
        known: dict[int, list] = {}
        for (text, anchor), (bucket, places) in held.items():
            doc, start = places[0]
            new.setdefault(bucket, []).append((text, anchor, doc, start))
            if len(places) > 1:
                for doc, start in places:
                    known.setdefault(doc % buckets, []).append((doc, start, start + len(text)))
        out = {n: [] for n in ("bucket", "known", "text", "lengths", "anchors", "doc", "start", "stop")}
        pack = lambda kind, values: np.array(values, kind).tobytes()
        for bucket, rows in new.items():
            for name, value in (
                    ("bucket", bucket), ("known", False), ("text", b"".join(r[0] for r in rows)),
                    ("lengths", pack(np.int32, [len(r[0]) for r in rows])),
                    ("anchors", pack(np.int32, [r[1] for r in rows])),
                    ("doc", pack(np.int64, [r[2] for r in rows])),
                    ("start", pack(np.int64, [r[3] for r in rows])), ("stop", b"")):
                out[name].append(value)
        for bucket, rows in known.items():
            for name, value in (
                    ("bucket", bucket), ("known", True), ("text", b""), ("lengths", b""), ("anchors", b""),
                    ("doc", pack(np.int64, [r[0] for r in rows])),
                    ("start", pack(np.int64, [r[1] for r in rows])),
                    ("stop", pack(np.int64, [r[2] for r in rows]))):
                out[name].append(value)
        yield pa.RecordBatch.from_pydict({
            n: pa.array(v, pa.int32() if n == "bucket" else pa.bool_() if n == "known" else pa.binary())
            for n, v in out.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        size = 0
        flags = sketched.value
        for data, offsets, ids, base in _segments(batches, length):
            anchor, low, high, key = _anchors(data, offsets, length, gram)
            maybe = sketch.maybe_repeated(key, flags, bits)
            if not maybe.any():
                continue
            anchor, low, high, key = anchor[maybe], low[maybe], high[maybe], key[maybe]
            row = np.searchsorted(offsets, low, "right") - 1
            docs = ids[row].tolist()
            place = (low - offsets[row] + base[row]).tolist()
            bucket = (key % np.uint64(buckets)).astype(np.int64).tolist()
            raw = data.tobytes()
            for a, lo, hi, doc, at, b in zip(anchor.tolist(), low.tolist(), high.tolist(), docs, place, bucket,
                                             strict=True):
                text = raw[lo: hi + length]
                found = held.get((text, a - lo))
                if found is None:
                    held[(text, a - lo)] = (b, [(doc, at)])
                    size += len(text) + 200
                else:
                    found[1].append((doc, at))
                    size += 100
            if size >= HELD:
                yield from flush(held)
                held, size = {}, 0
        if held:
            yield from flush(held)

    return run


def repeated_offsets(texts: list[bytes], anchors: np.ndarray, length: int) -> np.ndarray:
    """For each context, by start: does its ``length``-byte string occur in another context, anchored alike?

    Returns a boolean matrix over distances from start to anchor; exact, by the two sorted orders.
    """
    n = len(texts)
    far = int(anchors.max(initial=0))
    hit = np.zeros((n, far + 1), bool)
    right, right_lcp = deep_shallow([t[a:] for t, a in zip(texts, anchors, strict=True)])
    left, left_lcp = deep_shallow([t[:a][::-1] for t, a in zip(texts, anchors, strict=True)])
    ends = np.array([len(t) for t in texts]) - length
    least, most = anchors - ends, anchors
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for back in range(max(0, int(least.min(initial=0))), far + 1):
        right_class[right] = np.cumsum(right_lcp < length - back)
        left_class[left] = np.cumsum(left_lcp < back)
        live = np.flatnonzero((least <= back) & (back <= most))
        if len(live) < 2:
            continue
        pair = right_class[live] * (n + 1) + left_class[live]
        order = np.argsort(pair, kind="stable")
        p = pair[order]
        same = p[1:] == p[:-1]
        if same.any():
            hit[live[order], back] = np.r_[False, same] | np.r_[same, False]
    return hit


def _sorted_bucket(length: int, buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        known, new = pdf[pdf["known"]], pdf[~pdf["known"]]
        docs = [np.frombuffer(b"".join(known["doc"]), np.int64)]
        begin = [np.frombuffer(b"".join(known["start"]), np.int64)]
        stop = [np.frombuffer(b"".join(known["stop"]), np.int64)]
        if len(new):
            sizes = np.frombuffer(b"".join(new["lengths"]), np.int32).astype(np.int64)
            anchors = np.frombuffer(b"".join(new["anchors"]), np.int32).astype(np.int64)
            doc = np.frombuffer(b"".join(new["doc"]), np.int64)
            start = np.frombuffer(b"".join(new["start"]), np.int64)
            raw = b"".join(new["text"])
            cut = np.r_[0, np.cumsum(sizes)].tolist()
            texts = [raw[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
            hit = repeated_offsets(texts, anchors, length)
            # back = anchor - start: runs of consecutive distances are runs of consecutive starts.
            edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            i, near = np.nonzero(edge == 1)
            _, far = np.nonzero(edge == -1)
            origin = start[i] + anchors[i]
            docs.append(doc[i])
            begin.append(origin - (far - 1))
            stop.append(origin - near + length)
        doc, begin, stop = np.concatenate(docs), np.concatenate(begin), np.concatenate(stop)
        return packed.deal(doc, np.stack([begin, stop], 1), buckets)

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id and packed pairs of int64 (begin, stop) of repeated bytes (``found``); one row a document."""
    spark = docs.sparkSession
    rows = docs.select(ordered_id().alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = sketch.bits_for(size * 2 / (length - gram + 2))
    flags = spark.sparkContext.broadcast(sketch.repeated_bits(rows, _keys(length, gram), bits))
    buckets = partitions(spark)
    found = rows.mapInArrow(_contexts(length, gram, flags, bits, buckets), CONTEXT)
    dealt = found.groupBy("bucket").applyInPandas(_sorted_bucket(length, buckets), packed.DEALT)
    return dealt.groupBy("to").applyInPandas(packed.gather(np.int64, 2), packed.GATHERED)


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of a set of (begin, stop) pairs; touching ones are one."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.r_[first[1:], len(spans)] - 1]], 1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, runs, kept = [], [], [], []
        for text, found in zip(batch.column("text"), batch.column("found"), strict=True):
            raw = text.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            pairs = found.as_py()
            total.append(len(raw))
            if pairs:
                spans = merged(np.frombuffer(pairs, np.int64).reshape(-1, 2))
                spans = spans[spans[:, 1] <= len(raw)]
                edges = [0, *spans.reshape(-1).tolist(), len(raw)]
                rest = b"".join(raw[i:j] for i, j in zip(edges[::2], edges[1::2], strict=True))
            else:
                spans, rest = (), raw
            runs.append(len(spans))
            gone.append(len(raw) - len(rest))
            kept.append(rest)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (total, gone, runs)),
             pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes; may split a character), one row a document."""
    docs = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = repeated_spans(docs.select(F.col("__id").alias("doc_id"), "text"), length, gram)
    joined = docs.join(found.withColumnRenamed("doc_id", "__id"), "__id", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
