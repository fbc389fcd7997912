"""Vectorised helpers over Arrow string batches: byte buffers, words, rolling hashes, window minima.

All hashes are 64-bit polynomials over the ring of integers modulo 2**64 with an odd
base, so a window's hash is a difference of prefix sums times a power of the inverse base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE2 = 0xC2B2AE3D27D4EB4F | 1
CHUNK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Bytes that end a word: space and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


BYTE_VALUE = _table(11)
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, grown as needed."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + (CHUNK >> 1))
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 2**64), U)
        up[0] = down[0] = 1
        have = _powers[base] = (np.cumprod(up, dtype=U), np.cumprod(down, dtype=U))
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every bit of a 64-bit value over all others."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def prefix_sums(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    up, _ = powers(len(values) + 1, base)
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * up[: len(values)], dtype=U, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    _, down = powers(len(sums), base)
    return mix((sums[end] - sums[start]) * down[start])


def window_hash(sums: np.ndarray, width: int, base: int = _BASE) -> np.ndarray:
    """Hash of every window of ``width`` values, by its start."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, U)
    _, down = powers(len(sums), base)
    return mix((sums[width:] - sums[:n]) * down[:n])


def second_window_hash(values: np.ndarray, width: int) -> np.ndarray:
    return window_hash(prefix_sums(values, _BASE2), width, _BASE2)


def sliding_argmin(keys: np.ndarray, width: int, bits: int = 24) -> np.ndarray:
    """Position of the leftmost least key in every window of ``width``; compares the upper 64 - bits bits.

    Block-wise running minima from both sides give each window's minimum in constant time.
    """
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(keys) >= 1 << bits:
        raise ValueError("chunk too long for the position bits")
    mask = U((1 << bits) - 1)
    blocks = -(-len(keys) // width)
    at = np.full(blocks * width, U(2**64 - 1))
    at[: len(keys)] = (keys & ~mask) | np.arange(len(keys), dtype=U)
    grid = at.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return (np.minimum(back[:n], ahead[width - 1: width - 1 + n]) & mask).astype(np.int64)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    raw = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(raw[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           size: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``size`` bytes of text each, one row at least."""
    for batch in batches:
        _, offsets = buffers(batch.column(column))
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
            end = min(rows, max(start + 1, end))
            yield batch.slice(start, end - start)
            start = end


def words(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray = SPACE
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the first word of every row (length rows + 1)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~ends_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    edge = offsets[:-1]
    before[edge[edge < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    sums = prefix_sums((LOWER_VALUE if lower else BYTE_VALUE)[data])
    return span_hash(sums, start, end)


def covered(starts: np.ndarray, width: int, length: int) -> np.ndarray:
    """Which of ``length`` places lie in a window of ``width`` that begins at one of ``starts``."""
    step = np.zeros(length + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + width, length), -1)
    return np.cumsum(step[:-1]) > 0
