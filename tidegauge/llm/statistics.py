"""Statistics of whole texts for a classifier: shares of character kinds, words, repetition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tidegauge.llm.kernel import Texts, mix, slices, word_hashes

_LETTER = np.zeros(256, np.float32)
_LETTER[65:91] = _LETTER[97:123] = 1
_UPPER = np.zeros(256, np.float32)
_UPPER[65:91] = 1


def _of(chars: str) -> np.ndarray:
    out = np.zeros(256, np.float32)
    out[[ord(c) for c in chars]] = 1
    return out


_OTHER = np.zeros(256, np.float32)
_OTHER[0xC0:] = 1  # first byte of a character beyond ASCII

_LETTERS, _CAPITALS = (_LETTER + _OTHER).astype(np.uint8), _UPPER.astype(np.uint8)

#: Shares of a text's bytes.
KINDS = {
    "letters": _LETTER,
    "capitals": _UPPER,
    "digits": _of("0123456789"),
    "beyond_ascii": _OTHER,
    "stops": _of(".?"),
    "exclamations": _of("!"),
    "commas": _of(",;:"),
    "quotes": _of("\"'`"),
    "brackets": _of("()[]{}<>"),
    "bars": _of("|\\/_"),
    "symbols": _of("#$%&*+=@^~"),
    "hyphens": _of("-"),
    "lines": _of("\n"),
    "white": _of(" \t\r\x0b\x0c"),
}
NAMES = [*KINDS, "log_bytes", "log_words", "word_length", "word_spread", "long_words", "short_words", "distinct", "distinct_pairs", "echoes", "capital_words", "ends_marked", "bare_words"]


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _sums(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    return total[high] - total[low]


def _byte_counts(texts: Texts) -> np.ndarray:
    """How often each byte value occurs in each text, for a slice of bounded size."""
    out = np.zeros((len(texts.ends), 256), np.float64)
    for row, (a, b) in enumerate(zip(texts.starts.tolist(), texts.ends.tolist(), strict=True)):
        out[row] = np.bincount(texts.data[a:b], minlength=256)
    return out


def _distinct(keys: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Distinct hashes per text; 44 bits of them, which is plenty for a statistic."""
    both = np.sort((owner.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20)))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    return np.bincount((both[new] >> np.uint64(44)).astype(np.int64), minlength=texts).astype(np.float64)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text; an empty or null text has zeros."""
    out = [np.zeros((0, len(NAMES)))]
    for texts in slices(column):
        starts, ends = texts.starts, texts.ends
        size = (ends - starts).astype(np.float64)
        words, hashes = word_hashes(texts)
        count = (words.last - words.first).astype(np.float64)
        length = (words.ends - words.starts).astype(np.float64)
        owner = np.repeat(np.arange(len(ends)), (words.last - words.first))
        counts = _byte_counts(texts)
        byte = [_ratio(counts @ kind, size) for kind in KINDS.values()]
        letter = np.concatenate(([0], np.cumsum(_LETTERS[texts.data], dtype=np.int64)))
        upper = np.concatenate(([0], np.cumsum(_CAPITALS[texts.data], dtype=np.int64)))
        letters, uppers = letter[words.ends] - letter[words.starts], upper[words.ends] - upper[words.starts]
        last = texts.data[words.ends - 1] if len(length) else np.zeros(0, np.uint8)
        echo = np.zeros(len(hashes))
        echo[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        pair = hashes.copy()
        pair[1:] = mix(hashes[1:] * np.uint64(0x9E3779B97F4A7C15) + hashes[:-1])
        per_word = {
            "mean": length,
            "square": length**2,
            "long": length > 15,
            "short": length < 3,
            "echo": echo,
            "capital": (uppers > 1) & (uppers * 2 > letters),
            "marked": ((last >= 33) & (last < 48)) | ((last >= 58) & (last < 65)),
            "bare": letters == 0,
        }
        w = {k: _ratio(_sums(v, words.first, words.last), count) for k, v in per_word.items()}
        spread = np.sqrt(np.maximum(w["square"] - w["mean"] ** 2, 0))
        distinct, pairs = (_ratio(_distinct(k, owner, len(ends)), count) for k in (hashes, pair))
        word = [np.log1p(size), np.log1p(count), w["mean"], spread, w["long"], w["short"], distinct, pairs, w["echo"], w["capital"], w["marked"], w["bare"]]
        out.append(np.stack([*byte, *word], axis=1))
    return np.concatenate(out)
