"""Elias-Fano code of a sorted list of whole numbers.

n numbers up to u are kept in about ``2 + log2(u / n)`` bits each: the low
bits as they are, the high bits as a bit string with a one per number. A
directory holds the count of ones before every 512 bits, so that the i-th
number is found by a search in the directory and one look at 64 bytes.

Bytes: n, u (8 each), number of low bits, bytes of low and of high bits (8
each), directory (4 bytes an entry), low bits, high bits; little-endian.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQQQ")
_SPAN = 512


class EliasFano:
    def __init__(self, n: int, top: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.top, self.low_bits, self.low, self.high, self.directory = n, top, low_bits, low, high, directory

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        """Of sorted numbers, equal ones allowed, none below 0."""
        values = np.asarray(values, np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        if n and np.any(values[1:] < values[:-1]):
            raise ValueError("the numbers are not sorted")
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        n_bits = n + (top >> low_bits) + 1
        ones = np.zeros(-(-n_bits // _SPAN) * _SPAN, np.uint8)
        ones[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        counts = ones.reshape(-1, _SPAN).sum(axis=1, dtype=np.int64)
        return cls(n, top, low_bits, low, np.packbits(ones, bitorder="little"), (np.cumsum(counts) - counts).astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.top, self.low_bits, len(self.low), len(self.high))
        return head + self.directory.astype("<u4").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The list that begins at a place of ``data``, and where it ends."""
        n, top, low_bits, n_low, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_dir = n_high * 8 // _SPAN
        directory = np.frombuffer(data, "<u4", n_dir, at)
        at += 4 * n_dir
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        return cls(n, top, low_bits, low, high, directory), at + n_low + n_high

    def select(self, which: np.ndarray) -> np.ndarray:
        """The numbers at places ``which`` of the list, without decoding the others."""
        which = np.asarray(which, np.int64)
        if len(which) == 0:
            return np.empty(0, np.int64)
        if which.min() < 0 or which.max() >= self.n:
            raise IndexError("place outside the list")
        out = np.empty(len(which), np.int64)
        span_bytes = _SPAN // 8
        for i in range(0, len(which), 8192):
            part = which[i : i + 8192]
            span = np.searchsorted(self.directory, part, side="right") - 1
            bits = np.unpackbits(self.high.reshape(-1, span_bytes)[span], axis=1, bitorder="little")
            rank = (part - self.directory[span] + 1).astype(np.uint16)
            place = np.argmax(np.cumsum(bits, axis=1, dtype=np.uint16) == rank[:, None], axis=1)
            out[i : i + 8192] = span * _SPAN + place - part
        if self.low_bits:
            at = which[:, None] * self.low_bits + np.arange(self.low_bits)
            bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            out = (out << self.low_bits) | (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return out
