"""Vectorised byte, word and window kernels over Arrow string columns.

Everything works on the UTF-8 buffer of a whole record batch: words are found with a
256-entry class table, word hashes come from a prefix sum of a rolling polynomial
(random 64-bit byte values, odd base, modulo 2**64) and windows of words from a
multilinear sum with fixed random odd keys. Both are finished by a bijective mixer.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa


def return_memory() -> None:
    """Has the C library map every array over 1 MB on its own, so that a Python worker, which
    Spark keeps from task to task, gives large arrays back as soon as they are dropped."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD; fixes it, too
    except (AttributeError, OSError):  # another C library
        pass


return_memory()

SPACE = bytes([0x20, *range(0x09, 0x0E)])
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(1, 2**62)) * 2 + 1
KEYS = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 1 << 19


def space_words() -> np.ndarray:
    """Class table of words that are runs of anything but ASCII white space."""
    table = np.ones(256, bool)
    table[list(SPACE)] = False
    return table


def alnum_words() -> np.ndarray:
    """Class table of words of ASCII letters, digits and every non-ASCII character."""
    table = np.zeros(256, bool)
    for a, b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
        table[a:b] = True
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i <= n."""
    if len(_powers.get("up", ())) <= n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            a = np.full(n + 1, base, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and each text's first word (n + 1 values)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = table[buf]
    edge = np.empty(len(buf), bool)
    edge[0] = False
    edge[1:] = inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(buf)]
    edge[bounds] = False
    starts = np.flatnonzero(inside & ~edge)
    edge[-1] = False
    edge[:-1] = inside[1:]
    bounds = offsets[1:] - 1
    edge[bounds[bounds >= 0]] = False
    ends = np.flatnonzero(inside & ~edge) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool, other: bool = False) -> np.ndarray:
    """64-bit hash of every word's bytes, A-Z folded first if asked; other: a second, independent one."""
    values = mix(BYTE_VALUES * KEYS[41]) if other else BYTE_VALUES
    values = values[lower_table()] if lower else values
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        s0, e1 = int(starts[i]), int(ends[j - 1])
        up, down = powers(max(e1 - s0, CHUNK))
        sums = np.empty(e1 - s0 + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values[buf[s0:e1]] * up[: e1 - s0], out=sums[1:])
        s, e = starts[i:j] - s0, ends[i:j] - s0
        out[i:j] = (sums[e] - sums[s]) * down[s]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the windows of `length` values starting at every position but the last ones."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, (length * 0x9E3779B97F4A7C15 + seed) & (2**64 - 1), np.uint64)
    for j in range(length):
        out += words[j : j + n] * (KEYS[j % 64] + np.uint64(2 * (j // 64)))
    return mix(out)


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Flat positions at which a window of `length` words fits into its own text."""
    n = int(first[-1])
    valid = np.ones(n, bool)
    for j in range(1, length):
        at = first[1:] - j
        valid[at[at >= first[:-1]]] = False
    return np.flatnonzero(valid)


def owner(first: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The text that each flat position belongs to."""
    return np.searchsorted(first, positions, "right") - 1


def covered(starts: np.ndarray, length, n: int) -> np.ndarray:
    """Which of n positions lie in [start, start + length) of any start."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, n), -1)
    return np.cumsum(steps[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    padded = np.zeros(len(mask) + 2, np.int8)
    padded[1:-1] = mask
    steps = np.diff(padded)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def kept_bytes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> bytes:
    """The kept words of one text, joined by one space."""
    if not keep.any():
        return b""
    s, e = starts[keep], ends[keep]
    sizes = e - s + 1
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    mask = np.zeros(len(buf) + 2, np.int8)
    mask[s] += 1
    mask[e] -= 1
    inside = np.cumsum(mask[:-2], dtype=np.int8).astype(bool)
    at = np.ones(len(out), bool)
    at[np.cumsum(sizes) - 1] = False
    out[at] = buf[inside]
    return out[:-1].tobytes()
