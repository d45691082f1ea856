"""Words of Arrow text columns as NumPy arrays.

A word is ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Its hash is a polynomial over its bytes modulo 2^64,
mixed at the end; all words of a batch are cut and hashed with a few array operations over its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that each output bit depends on each input bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, dtype=U64), np.full(n, _INVERSE, dtype=U64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << (max(n, CHUNK_BYTES) - 1).bit_length())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another and the offsets of each; null counts as empty."""
    column = pc.fill_null(column, "")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``start:stop`` with at most ``limit`` bytes of text (one row at least), their bytes and offsets."""
    if batch.num_rows == 0:
        return
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(offsets) - 1)
        yield start, stop, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
        start = stop


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the offset of each text's first word in them."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    ends_at = inside.copy()
    ends_at[:-1] &= ~inside[1:] | first[1:-1]
    return starts, np.flatnonzero(ends_at) + 1, np.searchsorted(starts, offsets).astype(np.int64)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, dtype=U64)
    up, down = powers(len(data))
    sums = np.empty(len(data) + 1, dtype=U64)
    sums[0] = 0
    np.cumsum(((_LOWER[data] if lower else data).astype(U64) + U64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the offset of each text's first word."""
    starts, ends, first = bounds(data, offsets)
    return hash_words(data, starts, ends), first


#: Odd multipliers by position, for sequences of words.
STEPS = mix(np.arange(1, 65, dtype=U64)) | U64(1)


def shingles(words: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words and the text each lies in. A text with fewer words has its whole
    sequence as the only one; a text without words has none."""
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    at = first[:-1][owner] + within
    padded = np.concatenate([words, np.zeros(width, dtype=U64)])
    out = np.zeros(len(owner), dtype=U64)
    short = counts[owner] < width
    for k in range(width):
        value = (padded[at + k] + U64(k + 1)) * STEPS[k]
        if short.any():
            value = np.where(short & (counts[owner] <= k), U64(0), value)
        out += value
    return mix(out + np.minimum(counts[owner], width).astype(U64)), owner


def distinct_per_text(values: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text and the offset of each text's first one."""
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(texts + 1)).astype(np.int64)
