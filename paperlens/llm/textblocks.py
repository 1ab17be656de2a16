"""Whole texts as numpy arrays: words, hashes and ragged lists of many documents at once.

Functions here run inside Spark tasks on one Arrow batch at a time. A batch is cut into blocks of
about ``BLOCK_BYTES`` of text (at least one document), so memory follows the longest document and
not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 19

# Fixed parameters of the hashes: one odd multiplier for positions, one seed for the byte table.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)

# The six characters that end a word: tab to carriage return, and the blank.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(27)
        values *= np.uint64(0x94D049BB133111EB)
        values ^= values >> np.uint64(31)
    return values


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multiplier and its inverse raised to 0 .. n - 1."""
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        for k, base in enumerate((MULTIPLIER, INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of a sequence of 64-bit values; equal spans have equal hashes."""
    up, down = powers(len(values) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        spans = (sums[ends] - sums[starts]) * down[starts]
        return mixed(spans + (ends - starts).astype(np.uint64))


# Spans from here on get a hash of their bytes: sums of powers modulo 2^64 agree on some long periodic words.
LONG = 256


def firm_hashes(content: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """``hashes`` of spans, those of long spans made from their whole content."""
    for k in np.flatnonzero(ends - starts >= LONG).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(content[starts[k]: ends[k]].tobytes())
    return hashes


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, byte offsets of the rows) of consecutive rows; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data_buffer or b"", np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row]: offsets[end]], offsets[row: end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, index of each row's first word): runs without space that stay in their row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    dark = ~space[data]
    first, last = dark.copy(), dark.copy()
    first[1:] &= ~dark[:-1]
    last[:-1] &= ~dark[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = dark[inner]
    last[inner - 1] = dark[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, index of each row's first word); ``lower`` folds A-Z only."""
    starts, ends, rows = word_bounds(data, offsets)
    data = LOWER[data] if lower else data
    return firm_hashes(data, starts, ends, span_hashes(BYTE_VALUES[data], starts, ends)), rows


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n - 1 positions have none."""
    size = max(len(words) - n + 1, 0)
    out = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * MULTIPLIER + words[k: k + size]
    return mixed(out)


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each item, from the index of each row's first item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all items of many spans, one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
