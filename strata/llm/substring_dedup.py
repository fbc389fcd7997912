"""Substring dedup over word windows with a count-min prefilter.

A window is ``width`` consecutive words of one document. A word is removed when some
window covering it has a word sequence that also starts earlier (smaller doc_id, or the
same document further ahead). Windows are judged on the input.

1. *Sketch.* Every window elects its least ``gram``-word sub-sequence; equal windows elect
   equal ones. Partitions count the elected sub-sequences in count-min sketches, which
   Spark merges. A sub-sequence's estimate is never below the count of any window
   that elected it, so windows with an estimate of one are surely unique.
2. *Exact pass.* Only windows estimated repeated are hashed (96 bits) and grouped. Each task
   keeps the first occurrence it has seen and ships that alone, as packed arrays by
   hash bucket; later ones in the same task are known repeats already. A hot window thus
   reaches its bucket once for each batch of a task, not once for each document.
3. Flagged starts go back to their documents by doc_id; words are cut there.

Defined results: null or empty text has no words; each row is a document of its own: rows that share a
doc_id are ordered by text, of equal ones one is the first; rows without doc_id come last. Texts over
``SEGMENT`` bytes are cut between words into segments that overlap by ``width - 1`` words. Extra columns are ignored.
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

GRAM, SEGMENT = 8, 1 << 22


def _segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes, row offsets, row ids and the number of each row's first word in its document.

    Slices of whole documents, or parts of one that is longer than ``SEGMENT``.
    """
    for batch in tb.chunks(batches):
        data, offsets = tb.buffers(batch.column("text"))
        ids = (batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
               if "doc_id" in batch.schema.names else np.zeros(batch.num_rows, np.int64))
        if len(data) <= 2 * SEGMENT:
            yield data, offsets, ids, np.zeros(len(ids), np.int64)
            continue
        for i in range(len(ids)):
            yield from _parts(data[offsets[i]: offsets[i + 1]], ids[i: i + 1], width)


def _parts(text: np.ndarray, row: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """One document in parts: each begins ``width - 1`` words before the last one's end."""
    begin, number = 0, 0
    while begin < len(text):
        at, stop, ends = begin, min(len(text), begin + SEGMENT), 0
        while True:
            space = tb.SPACE[text[at: stop + 1]]
            ends += np.count_nonzero(~space[:-1] & space[1:])
            if ends >= width or stop == len(text):
                break
            at, stop = stop, min(len(text), stop + SEGMENT)
        part = text[begin: stop]
        if stop < len(text) and not tb.SPACE[text[stop]]:
            # The word that the cut goes through belongs to the next part.
            part = part[: np.flatnonzero(tb.SPACE[part])[-1]]
        edge = np.array([0, len(part)])
        start = tb.words(part, edge)[0]
        yield part, edge, row, np.array([number])
        if stop == len(text):
            return
        ahead = len(start) - (width - 1)
        number += ahead
        begin += int(start[ahead])


class _Chunk:
    """Windows of a slice of documents."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int):
        start, end, first = tb.words(data, offsets)
        self.hashes = tb.word_hashes(data, start, end)
        self.first = first
        n = len(start) - width + 1
        if n <= 0:
            self.windows = np.zeros(0, np.int64)
            return
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.row = rows
        grams = tb.window_hash(tb.prefix_sums(self.hashes), gram)
        elected = tb.sliding_argmin(grams, width - gram + 1)[:n]
        valid = rows[:n] == rows[width - 1: width - 1 + n]
        self.windows = np.flatnonzero(valid)
        self.elected = elected[self.windows]
        self.keys = grams

    def elections(self) -> np.ndarray:
        """Keys of the elected sub-sequences, one for each place elected."""
        if not len(self.windows):
            return np.zeros(0, np.uint64)
        new = np.r_[True, self.elected[1:] != self.elected[:-1]]
        return self.keys[self.elected[new]]


def _keys(width: int, gram: int):
    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for data, offsets, _, _ in _segments(batches, width):
            yield _Chunk(data, offsets, width, gram).elections()

    return keys_of


CANDIDATE = "bucket int, known boolean, h1 binary, h2 binary, doc binary, pos binary"
HELD = 1 << 19


def _candidates(width: int, gram: int, sketched, bits: int, buckets: int):
    """Per task: first occurrences of maybe repeated windows by hash bucket, and repeats known already."""

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, pos = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((pos, doc, h2, h1))
        h1, h2, doc, pos = h1[order], h2[order], doc[order], pos[order]
        head = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        group = np.cumsum(head) - 1
        lead = np.flatnonzero(head)[group]
        later = (doc != doc[lead]) | (pos != pos[lead])
        for known, take, bucket in (
                (False, head, (h1 % np.uint64(buckets)).astype(np.int64)),
                (True, later, (tb.mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64))):
            at = np.flatnonzero(take)
            if not len(at):
                continue
            at = at[np.argsort(bucket[at], kind="stable")]
            b = bucket[at]
            cut = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
            ends = np.r_[cut[1:], len(at)]
            pieces = [at[i:j] for i, j in zip(cut, ends, strict=True)]
            none = [b""] * len(pieces)
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(b[cut], pa.int32()),
                "known": pa.array([known] * len(pieces), pa.bool_()),
                "h1": pa.array(none if known else [h1[x].tobytes() for x in pieces], pa.binary()),
                "h2": pa.array(none if known else [h2[x].tobytes() for x in pieces], pa.binary()),
                "doc": pa.array([doc[x].tobytes() for x in pieces], pa.binary()),
                "pos": pa.array([pos[x].tobytes() for x in pieces], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        flags = sketched.value
        for data, offsets, ids, number in _segments(batches, width):
            c = _Chunk(data, offsets, width, gram)
            if not len(c.windows):
                continue
            change = np.r_[True, c.elected[1:] != c.elected[:-1]]
            maybe = sketch.maybe_repeated(c.keys[c.elected[change]], flags, bits)[np.cumsum(change) - 1]
            at = c.windows[maybe]
            if not len(at):
                continue
            h1 = tb.window_hash(tb.prefix_sums(c.hashes), width)[at]
            h2 = (tb.second_window_hash(c.hashes, width)[at] >> np.uint64(32)).astype(np.uint32)
            row = c.row[at]
            held.append((h1, h2, ids[row], (at - c.first[row] + number[row]).astype(np.int32)))
            n += len(at)
            if n >= HELD:
                yield from flush(held)
                held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _repeats(buckets: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of one hash bucket: every start that is not its sequence's first."""
        doc, pos = _later_starts(pdf)
        return packed.deal(doc, pos, buckets)

    return run


def _later_starts(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    read = lambda name, kind, rows: np.frombuffer(b"".join(pdf.loc[rows, name]), kind)
    known, new = pdf["known"].to_numpy(bool), ~pdf["known"].to_numpy(bool)
    docs, starts = [read("doc", np.int64, known)], [read("pos", np.int32, known)]
    if new.any():
        h1, h2 = read("h1", np.uint64, new), read("h2", np.uint32, new)
        doc, pos = read("doc", np.int64, new), read("pos", np.int32, new)
        order = np.lexsort((pos, doc, h2, h1))
        h1, h2, doc, pos = h1[order], h2[order], doc[order], pos[order]
        head = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        lead = np.flatnonzero(head)[np.cumsum(head) - 1]
        later = (doc != doc[lead]) | (pos != pos[lead])
        docs.append(doc[later])
        starts.append(pos[later])
    return np.concatenate(docs), np.concatenate(starts)


def repeated_windows(docs: DataFrame, width: int = 20, gram: int = GRAM) -> DataFrame:
    """doc_id and packed int32 word starts (``found``) of windows that also start earlier; one row a document."""
    spark = docs.sparkSession
    rows = docs.select(ordered_id().alias("doc_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # About six bytes a word; of width - gram + 2 neighbouring grams two are elected.
    bits = sketch.bits_for(size / 6 * 2 / (width - gram + 2))
    flags = spark.sparkContext.broadcast(
        sketch.repeated_bits(rows.select("text"), _keys(width, gram), bits))
    buckets = partitions(spark)
    found = rows.mapInArrow(_candidates(width, gram, flags, bits, buckets), CANDIDATE)
    dealt = found.groupBy("bucket").applyInPandas(_repeats(buckets), packed.DEALT)
    return dealt.groupBy("to").applyInPandas(packed.gather(np.int32), packed.GATHERED)


def _cut(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, flags in zip(batch.column("text"), batch.column("found"), strict=True):
                raw = text.as_buffer()
                found = raw.to_pybytes().split() if raw is not None else []
                n.append(len(found))
                flagged = flags.as_py()
                if flagged:
                    starts = np.frombuffer(flagged, np.int32).astype(np.int64)
                    drop = tb.covered(starts[starts + width <= len(found)], width, len(found))
                    found = [w for w, d in zip(found, drop, strict=True) if not d]
                gone.append(n[-1] - len(found))
                kept.append(b" ".join(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"])

    return run


def dedup_windows(docs: DataFrame, width: int = 20, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space), one row for each input row."""
    docs = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = repeated_windows(docs.select(F.col("__id").alias("doc_id"), "text"), width, gram)
    joined = docs.join(found.withColumnRenamed("doc_id", "__id"), "__id", "left").select("doc_id", "text", "found")
    return joined.mapInArrow(_cut(width), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


__all__ = ["dedup_windows", "digest", "repeated_windows"]
