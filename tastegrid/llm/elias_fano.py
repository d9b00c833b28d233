"""Elias-Fano sequences in flat buffers, read in place by whole arrays of questions."""

from __future__ import annotations

import mmap

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# _PLACE[b, k]: position of the k-th set bit of byte b (8 where there is none)
_PLACE = np.full((256, 8), 8, np.uint8)
for _b in range(256):
    _set = [k for k in range(8) if _b >> k & 1]
    _PLACE[_b, : len(_set)] = _set


def mapped(array: np.ndarray) -> np.ndarray:
    """The array's bytes in an anonymous memory map, outside the heap, viewed in place."""
    array = np.ascontiguousarray(array)
    if not array.nbytes:
        return array
    region = mmap.mmap(-1, array.nbytes)
    region.write(array.view(np.uint8).data)
    return np.frombuffer(region, array.dtype)


class EliasFano:
    """An ascending sequence of n numbers below ``universe``, about 2 + log2(universe / n)
    bits each: low bits side by side, high parts as ones between zeros."""

    def __init__(self, values: np.ndarray, universe: int):
        n = len(values)
        values = values.astype(np.uint64)
        self.n = n
        self.low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        bits = self.low_bits
        lows = values & np.uint64((1 << bits) - 1)
        packed = np.zeros((n * bits + 7) // 8 + 8, np.uint8)
        if bits and n:
            places = np.arange(bits, dtype=np.uint64)
            flat = ((lows[:, None] >> places[None]) & np.uint64(1)).astype(np.uint8).ravel()
            bytes_ = np.packbits(flat, bitorder="little")
            packed[: len(bytes_)] = bytes_
        self.lows = mapped(packed)
        highs = (values >> np.uint64(bits)).astype(np.int64)
        self.buckets = (max(universe - 1, 0) >> bits) + 1
        upper = np.zeros(n + self.buckets, np.uint8)
        upper[highs + np.arange(n)] = 1
        self.upper = mapped(np.packbits(upper, bitorder="little"))
        ones = np.cumsum(_ONES[self.upper], dtype=np.int64)
        self.ones = mapped(np.concatenate([[0], ones]).astype(np.uint32))
        self.zeros = mapped(
            (8 * np.arange(len(self.ones)) - np.asarray(self.ones, np.int64)).astype(np.uint32)
        )

    def _low(self, index: np.ndarray) -> np.ndarray:
        bits = self.low_bits
        out = np.zeros(len(index), np.uint64)
        if bits:
            first = index * bits
            byte, shift = first >> 3, (first & 7).astype(np.uint64)
            for k in range((bits + 14) // 8):
                part = self.lows[byte + k].astype(np.uint64)
                move = np.uint64(8 * k) - shift if k else None
                out |= (part >> shift) if k == 0 else (part << move)
            out &= np.uint64((1 << bits) - 1)
        return out

    def _select(self, directory: np.ndarray, flip: bool, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) one of the upper bits, or zero if ``flip``."""
        byte = np.searchsorted(directory, k, "right") - 1
        value = self.upper[byte]
        value = ~value if flip else value
        return 8 * byte + _PLACE[value, k - directory[byte]].astype(np.int64)

    def at(self, index: np.ndarray) -> np.ndarray:
        high = self._select(self.ones, False, index) - index
        return (high.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(index)

    def find(self, values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Index in first..last-1 of the successor of each value there if it equals it,
        else -1: the high part's run of ones, then its low bits by halving."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        before = self._select(self.zeros, True, np.maximum(high - 1, 0))
        low = np.where(high > 0, before - high + 1, 0)
        stop = self._select(self.zeros, True, high) - high
        low, end = np.maximum(low, first), np.minimum(stop, last)
        stop = end
        wanted = values & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(low < stop)
        low, stop = low.copy(), stop.copy()
        while len(open_):
            middle = (low[open_] + stop[open_]) >> 1
            less = self._low(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]
            open_ = open_[low[open_] < stop[open_]]
        inside = low < end
        hit = np.zeros(len(values), bool)
        hit[inside] = self._low(low[inside]) == wanted[inside]
        return np.where(hit, low, -1)
