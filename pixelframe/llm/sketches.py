"""Arrays of a fixed size, summed over all rows: counts and bitmaps by hash range."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernels as K
from .common import cut, map_batches

BITS = 21
CELLS = 1 << BITS


def cells(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def pack(counts: np.ndarray) -> bytes:
    return pa.compress(np.minimum(counts, 2**31 - 1).astype(np.int32).tobytes(), "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * CELLS, "zstd", asbytes=True), np.int32)


def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CELLS, np.int64)
    for b in batches:
        for x in b.column("sketch").to_pylist():
            total += unpack(x)
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array([pack(total)], pa.binary())], ["sketch"])


def total(sketches: DataFrame) -> np.ndarray:
    """The sum of all rows, added up in a tree: no task and not the driver holds more than a
    few of them."""
    while (n := sketches.rdd.getNumPartitions()) > 16:
        sketches = cut(map_batches(sketches.coalesce(-(-n // 16)), add, "sketch binary"))
    out = np.zeros(CELLS, np.int64)
    for r in map_batches(sketches, add, "sketch binary").collect():
        out += unpack(bytes(r["sketch"]))
    return out


def bit_count(n: int) -> int:
    """Bits (a power of two) of a bitmap of about n keys: 16 a key while that is at most 16 MB."""
    return 1 << min(27, max(20, int(16 * n - 1).bit_length()))


class Bitmap:
    """Marked 64-bit hashes; others are marked too, the more the fuller it is. Travels compressed."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def __getstate__(self) -> tuple[int, bytes]:
        return len(self.data), pa.compress(self.data.tobytes(), "zstd", asbytes=True)

    def __setstate__(self, state: tuple[int, bytes]) -> None:
        self.data = np.frombuffer(pa.decompress(state[1], state[0], "zstd", asbytes=True), np.uint8)

    def __bool__(self) -> bool:
        return bool(self.data.any())

    def __or__(self, other: Bitmap) -> Bitmap:
        return Bitmap(self.data | other.data)

    def add(self, h: np.ndarray) -> None:
        at = np.sort(self.places(h))
        byte = at >> 3
        first = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]])) if len(at) else at
        byte = byte[first]
        if len(at):
            self.data[byte] |= np.bitwise_or.reduceat((128 >> (at & 7)).astype(np.uint8), first)

    def places(self, h: np.ndarray) -> np.ndarray:
        return (K.mix(h * K.KEYS[31]) >> np.uint64(64 - (8 * len(self.data) - 1).bit_length())).astype(np.int64)

    def marked(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h)
        return (self.data[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def bitmap(keys: DataFrame, hashes, bits: int) -> Bitmap:
    """The bitmap of hashes(record batch); parts are joined in a tree."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Bitmap(np.zeros(bits // 8, np.uint8))
        for b in batches:
            found.add(hashes(b))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([found.__getstate__()[1]], pa.binary())], ["m"])

    def gather(parts) -> np.ndarray:
        found = np.zeros(bits // 8, np.uint8)
        for x in parts:
            found |= np.frombuffer(pa.decompress(x, len(found), "zstd", asbytes=True), np.uint8)
        return found

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Bitmap(gather(x for b in batches for x in b.column("m").to_pylist()))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([found.__getstate__()[1]], pa.binary())], ["m"])

    maps = map_batches(keys, mark, "m binary")
    while (n := maps.rdd.getNumPartitions()) > 8:
        maps = cut(map_batches(maps.coalesce(-(-n // 16)), join, "m binary"))
    return Bitmap(gather(bytes(r["m"]) for r in maps.toLocalIterator()))


def longs(b: pa.RecordBatch, name: str) -> np.ndarray:
    """The values of a binary column that holds many longs a row."""
    return np.frombuffer(b"".join(x or b"" for x in b.column(name).to_pylist()), np.int64)


def key_hash(*key: np.ndarray) -> np.ndarray:
    h = np.zeros(len(key[0]), np.uint64)
    for i, k in enumerate(key):
        h += K.mix(np.ascontiguousarray(k).view(np.uint64) * K.KEYS[10 + i])
    return K.mix(h)
