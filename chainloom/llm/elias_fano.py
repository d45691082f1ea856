"""Elias-Fano sequences over NumPy buffers, searched for many values at once.

A non-decreasing sequence of n values below a universe keeps the low bits of each value in n fields and the high bits
as gaps in a bit vector: about 2 + log2(universe / n) bits a value. Buffers can be memory-mapped.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_ONE = U64(1)


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Fields of ``bits`` bits each, one after another in 64-bit words, with a spare word at the end."""
    out = np.zeros((len(values) * bits + 63) // 64 + 1, dtype=U64)
    if bits and len(values):
        at = np.arange(len(values), dtype=U64) * U64(bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        values = values.astype(U64)
        np.bitwise_or.at(out, word, values << shift)
        over = shift + U64(bits) > U64(64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (U64(64) - shift[over]))
    return out


def unpack(words: np.ndarray, index: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(len(index), dtype=U64)
    at = index.astype(U64) * U64(bits)
    word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
    low = words[word] >> shift
    high = np.where(shift > U64(0), words[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
    return (low | high) & U64((1 << bits) - 1)


def _byte_table() -> np.ndarray:
    """Place of the rank-th set bit of a byte, at rank * 256 + byte."""
    table = np.zeros(8 * 256, dtype=np.uint64)
    for byte in range(256):
        for rank, place in enumerate(k for k in range(8) if byte >> k & 1):
            table[rank * 256 + byte] = place
    return table


_IN_BYTE = _byte_table()
_ONES, _TOPS = U64(0x0101010101010101), U64(0x8080808080808080)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th set bit (from 0) of each word: the byte by running sums of set bits, then a table."""
    rank = rank.astype(U64)
    sums = word - ((word >> U64(1)) & U64(0x5555555555555555))
    sums = (sums & U64(0x3333333333333333)) + ((sums >> U64(2)) & U64(0x3333333333333333))
    sums = ((sums + (sums >> U64(4))) & U64(0x0F0F0F0F0F0F0F0F)) * _ONES  # set bits up to each byte
    place = np.bitwise_count((((rank * _ONES) | _TOPS) - sums) & _TOPS).astype(U64) << U64(3)
    place = np.minimum(place, U64(56))
    left = rank - (((sums << U64(8)) >> place) & U64(0xFF))
    return place + _IN_BYTE[((left & U64(7)) << U64(8)) | ((word >> place) & U64(0xFF))]


class EliasFano:
    """A non-decreasing sequence of unsigned 64-bit values."""

    def __init__(self, n: int, bits: int, lows: np.ndarray, highs: np.ndarray, zeros: np.ndarray):
        """zeros[w]: zero bits of ``highs`` before word w."""
        self.n, self.bits, self.lows, self.highs, self.zeros = n, bits, lows, highs, zeros

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        high = (values >> U64(bits)).astype(np.int64)
        size = n + (top >> bits) + 2
        flags = np.zeros((size + 63) // 64 * 64, dtype=bool)
        flags[high + np.arange(n)] = True
        highs = np.packbits(flags, bitorder="little").view(U64)
        zeros = np.concatenate([[0], np.cumsum(64 - np.bitwise_count(highs).astype(np.int64))]).astype(np.uint32 if size < 1 << 32 else np.uint64)
        return cls(n, bits, pack(values & U64((1 << bits) - 1), bits), highs, zeros)

    def buffers(self) -> tuple[list[int], list[np.ndarray]]:
        return [self.n, self.bits], [self.lows, self.highs, self.zeros]

    def _zero(self, rank: np.ndarray) -> np.ndarray:
        """Place of the rank-th zero bit (from 0) in ``highs``."""
        word = np.searchsorted(self.zeros, rank.astype(self.zeros.dtype), side="right").astype(np.int64) - 1
        word = np.minimum(word, len(self.highs) - 1)
        return word * 64 + _select_in_word(~self.highs[word], rank - self.zeros[word].astype(np.int64)).astype(np.int64)

    def _group(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last index of the values with these high parts: the run of set bits after a zero."""
        bit = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0)
        start = bit - high
        word, shift = bit >> 6, (bit & 63).astype(U64)
        rest = ~self.highs[np.minimum(word, len(self.highs) - 1)] >> shift
        run = np.bitwise_count((rest & (~rest + U64(1))) - U64(1)).astype(np.int64)  # zeros below the lowest set bit
        long = np.flatnonzero(rest == U64(0))  # the run goes on in the next word
        if len(long):
            run[long] = self._zero(high[long]) - bit[long]
        return start, start + run

    def find(self, values: np.ndarray, bound=None) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first value not below each of ``values`` (n where there is none), and whether it is equal.

        ``bound(k)`` may narrow the search: it gives ranges of indices in which the successors of values[k] must lie.
        """
        if not self.n:
            return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
        values = values.astype(U64)
        wide = values >> U64(self.bits)
        most = U64(int(self.zeros[-1]) - 1)
        beyond = wide > most
        at, stop = self._group(np.minimum(wide, most).astype(np.int64))
        low = values & U64((1 << self.bits) - 1)
        at[beyond] = stop[beyond] = self.n
        if bound is not None and len(crowded := np.flatnonzero(stop - at > 64)):
            first, last = bound(crowded)
            at[crowded] = np.maximum(at[crowded], np.minimum(first, stop[crowded]))
            stop[crowded] = np.minimum(stop[crowded], np.maximum(last, at[crowded]))
        end = stop.copy()
        open_ = np.flatnonzero(at < stop)
        while len(open_):  # halve the range of values with the same high part
            middle = (at[open_] + stop[open_]) >> 1
            less = unpack(self.lows, middle, self.bits) < low[open_]
            at[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]
            open_ = open_[at[open_] < stop[open_]]
        equal = at < end
        equal[equal] = unpack(self.lows, at[equal], self.bits) == low[equal]
        return np.minimum(at, self.n), equal

    def get(self, index: np.ndarray) -> np.ndarray:
        """Values at ``index``."""
        ones = np.arange(len(self.zeros), dtype=np.int64) * 64 - self.zeros.astype(np.int64)
        word = np.searchsorted(ones, index, side="right") - 1
        word = np.minimum(word, len(self.highs) - 1)
        place = word * 64 + _select_in_word(self.highs[word], index - ones[word]).astype(np.int64)
        return ((place - index).astype(U64) << U64(self.bits)) | unpack(self.lows, index, self.bits)
