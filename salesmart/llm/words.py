"""Word segmentation of Arrow text columns with numpy.

A word is a maximal run of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. All of these are one byte in
UTF-8, so a column is cut on its bytes at once, without a Python loop over
words; the words of a batch are then dictionary-encoded by Arrow, so that
later work runs once per distinct word of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True

#: A batch is worked on in slices of about so many bytes of text (one row at least).
SLICE_BYTES = 8 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows (a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of ``column``, so that memory does not follow the batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, ends = text_bytes(batch.column(column))
        cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + 1, size), side="left").clip(0, batch.num_rows))
        edges = np.unique(np.concatenate(([0], cuts, [batch.num_rows])))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield batch.slice(int(a), int(b - a))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z made a-z; all other bytes, those of longer characters too, stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


@dataclass
class Words:
    """``codes[rows[i]:rows[i + 1]]`` are the words of row i, as numbers in ``vocabulary``."""

    rows: np.ndarray
    codes: np.ndarray
    vocabulary: pa.BinaryArray


def _encode(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.BinaryArray]:
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    array = pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _marks_after_letters(data: np.ndarray) -> np.ndarray:
    """Places of ``.,;:!?`` right after a Latin letter (ASCII, or one of U+00C0 to U+00FF)."""
    at = np.flatnonzero(_MARK[data[1:]]) + 1
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    ascii_letter = ((one | 0x20) >= 0x61) & ((one | 0x20) <= 0x7A)
    return at[ascii_letter | ((two == 0xC3) & (at > 1) & (one >= 0x80) & (one != 0x97) & (one != 0xB7))]


def words(column: pa.Array, lower: bool = False, marks: bool = False) -> Words:
    """The words of a column; with ``marks``, punctuation after a letter begins a word of its own."""
    data, ends = text_bytes(column)
    if len(data) == 0:
        return Words(np.zeros(len(ends), np.int64), np.empty(0, np.int64), pa.array([], pa.binary()))
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    first[edges] = inside[edges]
    if marks:
        first[_marks_after_letters(data)] = True
    starts = np.flatnonzero(first)
    kept = data[inside]
    lengths = np.diff(np.flatnonzero(first[inside]), append=len(kept))
    codes, vocabulary = _encode(lower_ascii(kept) if lower else kept, lengths)
    return Words(np.searchsorted(starts, ends, side="left"), codes, vocabulary)


def _may_be_wide_space(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place may be white space of more than one byte."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return (one < 0x21) | ((one >= 0x80) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3))))


def spaced_words(column: pa.Array) -> Words:
    """Runs of white space with the word after them; together they are the whole text.

    A cut is made before white space that follows a character which surely is
    none, and before punctuation after a letter. Tokenizers that attach spaces
    to the word behind them never join text across such a place.
    """
    data, ends = text_bytes(column)
    if len(data) == 0:
        return Words(np.zeros(len(ends), np.int64), np.empty(0, np.int64), pa.array([], pa.binary()))
    space = _SPACE[data]
    cut = np.zeros(len(data), bool)
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    cut[at[~_may_be_wide_space(data, at)]] = True
    cut[_marks_after_letters(data)] = True
    cut[ends[:-1][ends[:-1] < len(data)]] = True
    starts = np.flatnonzero(cut)
    codes, vocabulary = _encode(data, np.diff(np.concatenate((starts, [len(data)]))))
    return Words(np.searchsorted(starts, ends, side="left"), codes, vocabulary)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i], ..., starts[i] + lengths[i] - 1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
