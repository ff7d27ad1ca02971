"""Whole batches of texts as bytes: words, segment hashes and 64-bit mixing in numpy.

A batch of strings arrives from Spark as one Arrow buffer, so words are found and hashed with a
few vector operations for all texts of the batch. White space and A-Z are single bytes in UTF-8,
which makes the byte view exact. Batches are cut into slices of bounded size first, because a hash
takes eight bytes for each byte of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that a vector operation sees at a time; longer texts form a slice of their own.
SLICE_BYTES = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Texts(NamedTuple):
    """Some texts end to end: ``data[ends[i-1]:ends[i]]`` is the i-th; ``first`` is its row in the batch."""

    data: np.ndarray
    ends: np.ndarray
    first: int

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in order, in slices of about ``limit`` bytes; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield Texts(data[offsets[low] : offsets[high]], (offsets[low + 1 : high + 1] - offsets[low]).astype(np.int64), low)
        low = high


def pieces(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 * SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in batches of about ``limit`` bytes of text."""
    for batch in batches:
        n, low = batch.num_rows, 0
        if not n:
            continue
        texts = batch.column(column)
        ends = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32)
        ends = ends[texts.offset : texts.offset + n + 1].astype(np.int64)
        while low < n:
            high = max(int(np.searchsorted(ends, ends[low] + limit, "right")) - 1, low + 1)
            yield batch.slice(low, min(high, n) - low)
            low = high


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which each bit depends on all (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of the hash base and of its inverse, as long as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up, down = np.full(size, _BASE), np.full(size, _INVERSE)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte values weighted by powers of the base: what `segment_hashes` takes differences of."""
    up, _ = _POWERS.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def segment_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte segment; equal bytes have equal hashes wherever they stand."""
    _, down = _POWERS.of(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words(NamedTuple):
    """Words of a slice: bounds in its bytes, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    last: np.ndarray


def words_of(texts: Texts) -> Words:
    """Maximal runs of bytes other than space, tab, and the line separators; none crosses two texts."""
    inside = ~SPACE[texts.data]
    edge = np.zeros(len(inside) + 1, bool)
    if len(inside):
        edge[1:-1] = inside[1:] != inside[:-1]
        edge[0], edge[-1] = inside[0], inside[-1]
        cuts = texts.ends[:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(inside))]
        glued = np.unique(cuts[inside[cuts] & inside[cuts - 1]])
    else:
        glued = np.zeros(0, np.int64)
    at = np.flatnonzero(edge)
    starts, ends = at[0::2], at[1::2]
    if len(glued):
        starts = np.sort(np.concatenate((starts, glued)))
        ends = np.sort(np.concatenate((ends, glued)))
    return Words(starts, ends, np.searchsorted(starts, texts.starts), np.searchsorted(starts, texts.ends))


def word_hashes(texts: Texts) -> tuple[Words, np.ndarray]:
    """Words with A-Z lowered, as 64-bit hashes."""
    words = words_of(texts)
    sums = prefix_sums(LOWER[texts.data])
    return words, segment_hashes(sums, words.starts, words.ends)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` neighbouring hashes; the i-th begins at place i."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        total = (total + hashes[k : len(hashes) - n + 1 + k]) * _BASE
        total ^= total >> np.uint64(32)
    return mix(total)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places ``starts[i] .. starts[i]+counts[i]-1``, end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    out = np.ones(total, np.int64)
    kept = counts > 0
    s, c, e = starts[kept].astype(np.int64), counts[kept], ends[kept]
    out[0] = s[0]
    out[e[:-1]] = s[1:] - (s[:-1] + c[:-1] - 1)
    return np.cumsum(out)
