"""Byte ranges as Arrow strings, and bounded bit sets of 64-bit keys."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_BITS = 1 << 29  # 64 MB, whatever the number of keys
CHUNK_BITS = 1 << 20


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges of ``data`` as strings."""
    offsets = np.concatenate(([0], np.cumsum(end - start)))
    places = np.repeat(start - offsets[:-1], end - start) + np.arange(offsets[-1])
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[places])]
    return pa.Array.from_buffers(pa.large_string(), len(start), buffers)


@dataclass
class BitSet:
    """Two bits for each key. A key that is in is always found; others rarely while the keys are fewer than an
    eighth of the bits. Beyond that more of the others are found, so it may only serve to skip work."""

    bits: np.ndarray

    def __contains__(self, key: int) -> bool:
        return bool(self.holds(np.array([key], dtype=np.uint64))[0])

    def holds(self, keys: np.ndarray) -> np.ndarray:
        last = np.uint64(8 * len(self.bits) - 1)
        found = np.ones(len(keys), dtype=bool)
        for place in (keys & last, (keys >> np.uint64(33)) & last):
            found &= (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def _chunk_bytes(key: tuple, rows: pa.Table) -> pa.Table:
    bits = np.zeros(CHUNK_BITS, dtype=np.uint8)
    bits[rows["place"].to_numpy() % CHUNK_BITS] = 1
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def bit_set(keys: DataFrame, count: int) -> BitSet:
    """The set of the long column ``key``, of about ``count`` rows: 32 bits a key, and 64 MB at most. Chunks of it
    are made by tasks, each from the distinct bits of one chunk; the driver joins them."""
    size = CHUNK_BITS
    while size < min(32 * count, MOST_BITS):
        size *= 2

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit(size - 1))

    both = F.array(place(F.col("key")), place(F.shiftrightunsigned("key", 33)))
    places = keys.select(F.explode(both).alias("place")).distinct()
    made = places.withColumn("chunk", F.floor(F.col("place") / CHUNK_BITS)).groupBy("chunk").applyInArrow(_chunk_bytes, "chunk long, bits binary")
    out = np.zeros(size // 8, dtype=np.uint8)
    for row in made.collect():
        at = row["chunk"] * CHUNK_BITS // 8
        out[at : at + CHUNK_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return BitSet(out)
