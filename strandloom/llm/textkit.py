"""Vectorised words, shingles and hashes over whole Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, with A-Z
lower-cased. Texts are never cut; columns are worked through in slices of
about ``SLICE`` bytes so that memory depends on the longest text only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 21
SHINGLE = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SOLID = np.ones(256, dtype=bool)
_SOLID[[0x20, 9, 10, 11, 12, 13]] = False
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE + 1), base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 4 * SLICE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(text: str) -> np.uint64:
    return mix(np.array([sum(b << (8 * (i % 8)) for i, b in enumerate(text.encode())) & (2**64 - 1)], dtype=np.uint64))[0]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows; null texts count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    _, off, data = texts.buffers()
    off = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, side="right")) - 1)
        b = min(b, len(texts))
        yield a, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end of each word, first word of each row plus the total)."""
    if not len(data):
        z = np.empty(0, np.int64)
        return np.empty(0, np.uint64), z, z, np.zeros(len(off), np.int64)
    solid = _SOLID[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[off] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    before &= ~cut[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    after &= ~cut[1:]
    start = np.flatnonzero(solid & ~before)
    end = np.flatnonzero(solid & ~after) + 1
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data] if lower else data).astype(np.uint64) * _power(_BASE, len(data)) + _power(_BASE, len(data)), out=total[1:])
    h = mix((total[end] - total[start]) * _power(_BASE_INV, len(data))[start])
    return h, start, end, np.searchsorted(start, off).astype(np.int64)


def shingles(h: np.ndarray, first: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, first shingle of each row plus the total).

    A row of fewer than ``size`` words has one shingle of all of them; a row
    without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    out_first = np.zeros(len(first), np.int64)
    np.cumsum(count, out=out_first[1:])
    total = int(out_first[-1])
    if not total:
        return np.empty(0, np.uint64), out_first
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(total) - out_first[row] + first[row]
    width = np.minimum(n, size)[row]
    acc = np.zeros(total, np.uint64)
    mult = _power(0xD6E8FEB86659FD93 | 1, size + 1)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    for j in range(size):
        term = padded[at + j] * mult[j]
        acc += term if (n >= size).all() else np.where(j < width, term, np.uint64(0))
    return mix(acc + width.astype(np.uint64) * mult[size]), out_first


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text in turn."""
    for _, data, off in slices(texts):
        h, _, _, first = words(data, off)
        s, at = shingles(h, first, size)
        for i in range(len(at) - 1):
            yield np.unique(s[at[i] : at[i + 1]])


def partition_id() -> int:
    from pyspark import TaskContext

    c = TaskContext.get()
    return c.partitionId() if c else 0
