"""Words of a batch of texts as numpy arrays: where they are, and 64-bit hashes of them.

All functions look at whole texts. Work is cut into chunks of a few MB, so that memory follows
the longest single text and not the size of a batch."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
#: Odd constants of a well-known 64-bit mixing function (splitmix64).
STEP, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes that belong to a word, and the lower-casing of A-Z.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each text's offsets in them. A null is an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes."""
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


@dataclass
class Words:
    """data: bytes; start, end: of each word in them; first: index of each text's first word, with
    the number of words at the end."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def split_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Maximal runs of the bytes of ``kind`` within each text."""
    data = LOWER[data] if lower else data
    inside = kind[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def single_spaced(words: Words) -> Words:
    """The same words over bytes in which one space stands between the words of a text."""
    edges = np.zeros(len(words.data) + 1, dtype=np.int8)
    edges[words.start] += 1
    edges[words.end] -= 1
    kept = np.cumsum(edges, dtype=np.int8) > 0
    at_end = np.zeros(len(words.data) + 1, dtype=bool)
    at_end[words.end] = True
    at_end &= ~kept
    place = np.concatenate(([0], np.cumsum(kept | at_end)))
    data = np.where(at_end, np.uint8(0x20), np.concatenate((words.data, np.zeros(1, np.uint8))))
    return Words(data[kept | at_end], place[words.start], place[words.end], words.first)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes at a time."""
    length = words.end - words.start
    hashes = mixed(length.astype(np.uint64) * STEP + np.uint64(seed))
    padded = np.concatenate((words.data, np.zeros(8, np.uint8)))
    eights = np.ndarray((len(words.data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    low = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
    at, live = 0, np.arange(len(length))
    while len(live):
        part = eights[words.start[live] + at] & low[np.minimum(length[live] - at, 8)]
        hashes[live] = mixed((hashes[live] ^ part) * STEP + MIX_A)
        at += 8
        live = live[length[live] > at]
    return hashes


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes; windows may cross texts."""
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total = total * STEP + hashes[k : n + k]
    return mixed(total)


def whole_windows(words: Words, size: int) -> np.ndarray:
    """For each window start, whether the window lies within one text."""
    n = max(0, len(words.start) - size + 1)
    text = words.text
    return text[:n] == text[size - 1 :][:n]
