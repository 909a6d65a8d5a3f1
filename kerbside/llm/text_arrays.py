"""Words and word hashes of many texts at once, as numpy arrays over the bytes of an Arrow column.

The bytes of several texts are handled together: word limits come from a byte table, the hash of a
word from a prefix sum, and a hash never spans two texts. Working memory is about 60 times the bytes
of a chunk; a chunk is ``CHUNK_BYTES`` or, if larger, a single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_SEED = 20240607


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.full(size, U64(base % 2**64), dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(_STEP), powers(pow(_STEP, -1, 2**64))


def byte_table(lower: bool = True) -> np.ndarray:
    """Bytes as they count: A-Z as a-z if asked."""
    out = np.arange(256, dtype=np.uint8)
    if lower:
        out[65:91] += 32
    return out


def flags(*ranges: tuple[int, int]) -> np.ndarray:
    """True for the bytes in the inclusive ranges."""
    out = np.zeros(256, bool)
    for first, last in ranges:
        out[first : last + 1] = True
    return out


WHITE = flags((0x09, 0x0D), (0x20, 0x20))


@dataclass
class Words:
    """Words of a chunk of texts, in order; ``rows`` is the place of each word's text in the chunk."""

    rows: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # for each text, the place of its first word; one more entry at the end


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of texts; a null text has no bytes."""
    column = texts.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end, values[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, gap: np.ndarray) -> Words:
    """Words: runs of bytes that are not ``gap``, hashed after ``table``."""
    n, texts = len(data), len(offsets) - 1
    inside = ~gap[data]
    limit = np.zeros(n + 1, bool)
    limit[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if n else inside
    after = np.concatenate((inside[1:], [False])) if n else inside
    starts = np.flatnonzero(inside & (~before | limit[:-1]))
    ends = np.flatnonzero(inside & (~after | limit[1:])) + 1
    size = 1 << max(20, int(n + 1).bit_length())
    up, down = _powers(size) if size == 1 << 20 else _powers.__wrapped__(size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values()[table[data]] * up[:n], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    rows = np.searchsorted(offsets[1:], starts, "right")
    first = np.searchsorted(rows, np.arange(texts + 1), "left")
    return Words(rows, starts, ends, hashes, first)


def joined(hashes: np.ndarray, count: int) -> np.ndarray:
    """Hashes of every run of ``count`` neighbours (of all texts; see ``Words.rows`` for the limits)."""
    size = len(hashes) - count + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(size, U64(count), dtype=np.uint64)
    for at in range(count):
        out = out * U64(_STEP) + hashes[at : at + size]
        out = out ^ (out >> U64(29))
    return mixed(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles.

    A text with 1 to ``width`` - 1 words has its whole sequence as its one shingle; one without words
    has none.
    """
    words = words_of(data, offsets, byte_table(), WHITE)
    runs = joined(words.hashes, width)
    out = []
    for first, end in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if end - first >= width:
            out.append(np.unique(runs[first : end - width + 1]))
        elif end > first:
            out.append(joined(words.hashes[first:end], end - first))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
