"""Count-min sketch saturating at two, built by partitions, merged by Spark, used as a prefilter.

A cell holds 0, 1 or "2 or more". Partitions ship the cells they touched (each at most
twice), grouped by blocks of cells; a block's merged counts answer only "seen twice or
more", one bit a cell. Estimates are never too low, so a key seen twice always passes.
The merged bits are bounded by ``MAX_BITS`` whatever the input; past that load more keys
pass, and the exact second pass has more to do, but nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

U = np.uint64
DEPTH = 2
BLOCK_BITS = 16
#: Cells of one row of the sketch: at least 2**20, at most 2**28 (64 MB of bits for both rows).
MIN_BITS, MAX_BITS = 20, 28
_ODD = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))
FLUSH = 1 << 21


def bits_for(keys: float) -> int:
    """Cells for about an eighth of load, within the bounds."""
    return int(min(MAX_BITS, max(MIN_BITS, np.ceil(np.log2(max(1.0, keys) * 8)))))


def cells(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((keys * _ODD[row]) >> U(64 - bits)).astype(np.int64)


def _touched(keys: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    blocks, offsets = [], []
    for row in range(DEPTH):
        at = np.sort(cells(keys, row, bits))
        at = at[np.r_[[True] * min(2, len(at)), at[2:] != at[:-2]]]
        block = at >> BLOCK_BITS
        cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        low = (at & ((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        blocks += (block[cut] + (row << (bits - BLOCK_BITS))).tolist()
        offsets += [x.tobytes() for x in np.split(low, cut[1:])]
    yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int32()), "cells": pa.array(offsets, pa.binary())})


def repeated_bits(rows: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
                  bits: int) -> np.ndarray:
    """Packed bits of the merged sketch: which cells were hit twice or more."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for keys in keys_of(batches):
            held.append(keys)
            n += len(keys)
            if n >= FLUSH:
                yield from _touched(np.concatenate(held), bits)
                held, n = [], 0
        if n:
            yield from _touched(np.concatenate(held), bits)

    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(1 << BLOCK_BITS, np.uint8)
        for raw in pdf["cells"]:
            at = np.frombuffer(raw, np.uint16)
            twice = at[1:][at[1:] == at[:-1]]
            count[at] = np.minimum(count[at] + 1, 2)
            count[twice] = 2
        return pd.DataFrame({"block": [int(key[0])], "bits": [np.packbits(count > 1).tobytes()]})

    merged = rows.mapInArrow(build, "block int, cells binary").groupBy("block").applyInPandas(
        merge, "block int, bits binary")
    out = np.zeros((DEPTH << bits) >> 3, np.uint8)
    size = (1 << BLOCK_BITS) >> 3
    # Bounded by MAX_BITS: 2**28 cells in two rows are 64 MB of bits.
    for r in merged.collect():
        out[r["block"] * size: (r["block"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def maybe_repeated(keys: np.ndarray, packed: np.ndarray, bits: int) -> np.ndarray:
    """False only for keys that surely occur once."""
    ok = np.ones(len(keys), bool)
    for row in range(DEPTH):
        at = cells(keys, row, bits) + (row << bits)
        ok &= (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return ok
