"""Words, word hashes and word n-grams of whole texts as flat numpy arrays.

A word is a longest run of bytes outside space and 0x09-0x0D. Such bytes never occur inside a
multi-byte character, so UTF-8 is cut without decoding. Work goes over slices of about a
megabyte, so memory follows the longest single text, not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


def slices(batch: pa.RecordBatch, column: str,
           size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about `size` bytes of text, one row at least."""
    _, offsets = flat(batch.column(column))
    start, rows = 0, batch.num_rows
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1
        end = min(max(end, start + 1), rows)
        yield batch.slice(start, end - start)
        start = end


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and each row's offsets into them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    first, last = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(data, np.uint8)[first:last], offsets - first


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes, from eight bytes at a time."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    chunks = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    left = ends - starts
    h = mix(left.astype(np.uint64) + _ODD)
    at, todo = starts, np.arange(len(left))
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    while len(todo):
        h[todo] = mix((h[todo] ^ (chunks[at] & masks[np.minimum(left, 8)])) * _ODD)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


class Words:
    """Words of a slice: start and end byte, and per row the bounds of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~_SPACE[data]
        at_row = np.zeros(len(data) + 1, bool)
        at_row[offsets] = True
        before = np.concatenate(([False], inside[:-1])) & ~at_row[:-1]
        after = np.concatenate((inside[1:], [False])) & ~at_row[1:]
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    @classmethod
    def of(cls, column: pa.Array) -> Words:
        return cls(*flat(column))

    def rows(self) -> np.ndarray:
        """The row of every word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return hash_spans(self.data, self.starts, self.ends)

    def texts(self) -> list[list[bytes]]:
        """The words of each row as bytes."""
        raw = self.data.tobytes()
        return [raw[a:b].split() for a, b in zip(self.offsets[:-1], self.offsets[1:])]


def grams(hashes: np.ndarray, size: int, factor: int = 0xBF58476D1CE4E5B9) -> np.ndarray:
    """Hash of each `size` consecutive values, row bounds ignored."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    step = np.uint64(factor)
    for i in range(size):
        out = out * step + hashes[i:i + n]
    return mix(out)


def gram_rows(words: Words, size: int) -> np.ndarray:
    """Which of the grams lie in one row: a mask over the first word of each."""
    n = max(len(words.starts) - size + 1, 0)
    rows = words.rows()
    return rows[:n] == rows[size - 1:size - 1 + n]
