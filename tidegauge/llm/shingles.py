"""Shingle sets and min-max signatures of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidegauge.llm.kernel import gram_hashes, mix, slices, word_hashes

#: Words of a shingle.
WIDTH = 5


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes.

    A text of fewer words has one shingle, its whole sequence of words. One without words, an empty
    one and a null have none.
    """
    for texts in slices(column):
        words, hashes = word_hashes(texts)
        grams = gram_hashes(hashes, width)
        for low, high in zip(words.first.tolist(), words.last.tolist(), strict=True):
            if high - low >= width:
                yield np.unique(grams[low : high - width + 1])
            elif high > low:
                short = gram_hashes(hashes[low:high], high - low)
                yield mix(short ^ np.uint64(high - low))
            else:
                yield np.zeros(0, np.uint64)


def min_max(sets: list[np.ndarray], factors: np.ndarray) -> np.ndarray:
    """Per set and factor the smallest and the largest product: two signature values for one product."""
    ends = np.cumsum([len(s) for s in sets])
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    flat = np.concatenate(sets)
    out = np.empty((len(sets), 2 * len(factors)), np.uint64)
    product = np.empty_like(flat)
    for j, factor in enumerate(factors):
        np.multiply(flat, factor, out=product)
        product ^= product >> np.uint64(32)
        np.minimum.reduceat(product, starts, out=out[:, 2 * j])
        np.maximum.reduceat(product, starts, out=out[:, 2 * j + 1])
    return out
