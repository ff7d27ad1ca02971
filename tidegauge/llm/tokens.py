"""Token ids of whole texts, encoding each distinct piece of text once per worker.

The tokenizer treats white space and changes between letters and other characters as borders, so a
text's ids are those of its pieces, end to end. Pieces are found and hashed for all texts of a slice
at once; only pieces not seen before go to the tokenizer. A worker keeps what it has learnt for its
next task, up to a bound.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tidegauge.llm.kernel import LOWER, SPACE, Texts, prefix_sums, ranges, segment_hashes, words_of

#: Distinct pieces a worker remembers before it starts anew; about 50 bytes each.
MEMORY = 1_500_000
#: New pieces are kept apart up to this number, as sorting them in is a pass over all.
RECENT = 60_000

_KIND = np.full(256, 2, np.uint8)  # 1: ASCII letter, 2: other ASCII, 3: part of another character
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 3
_KIND[SPACE] = 0
#: Latin letters of two bytes begin with 0xC3; the multiplication and division signs are no letters.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
_APOSTROPHE = 39


def piece_bounds(texts: Texts, unsplit: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces: words, cut between letters and other characters where that is a border.

    Contractions such as 's may cross such a border, so nothing is cut beside an apostrophe. Strings
    of ``unsplit`` stay whole.
    """
    data = texts.data
    words = words_of(texts)
    if len(data) < 2:
        return words.starts, words.ends
    kind = _KIND[data]
    before, after = kind[:-1], kind[1:]
    cut = (before == 1) & (after == 2) | (before == 2) & (after == 1)
    lead = data == 0xC3
    latin = np.zeros(len(data), bool)
    latin[1:] = lead[:-1] & _LATIN[data[1:]]  # last byte of a Latin letter
    cut |= latin[:-1] & (after == 2)
    cut[:-1] |= (before[:-1] == 2) & latin[2:]
    plain = data != _APOSTROPHE
    cut &= plain[:-1] & plain[1:]
    if unsplit:
        raw = data.tobytes()
        for text in unsplit:
            at = raw.find(text)
            while at >= 0:
                cut[at : at + len(text) - 1] = False
                at = raw.find(text, at + 1)
    at = np.flatnonzero(cut) + 1
    # Where one text ends and the next begins without white space there is a border of words already.
    at = at[~np.isin(at, texts.ends)]
    return np.sort(np.concatenate((words.starts, at))), np.sort(np.concatenate((words.ends, at)))


class _Growing:
    """An array to which values are added at the end."""

    def __init__(self, kind) -> None:
        self.n, self.space = 0, np.zeros(1024, kind)

    def add(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.space):
            self.space = np.concatenate((self.space[: self.n], np.zeros(self.n + 2 * len(values), self.space.dtype)))
        self.space[self.n : self.n + len(values)] = values
        self.n += len(values)


class _Numbers:
    """Hashes in ascending order with the number of each."""

    def __init__(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        keys, values = np.concatenate((self.keys, keys)), np.concatenate((self.values, values))
        order = np.argsort(keys, kind="stable")  # fast on what is sorted in two parts
        self.keys, self.values = keys[order], values[order]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each hash, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], -1)


class Encoder:
    """A tokenizer and the pieces it has seen."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.unsplit = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for text, i in vocabulary.items() if text.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known, self.recent = _Numbers(), _Numbers()
        self.starts, self.counts, self.ids = _Growing(np.int64), _Growing(np.int64), _Growing(np.uint32)

    def _one_by_one(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], add_special_tokens=False)
        lists = [e.ids for e in found]
        counts = np.array([len(x) for x in lists], np.int64)
        return np.fromiter((i for x in lists for i in x), np.uint32, int(counts.sum())), counts

    def _letters(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of letters alone, sent as one text: each ends with the first token that closes a word."""
        line = data[np.minimum(ranges(starts, ends - starts + 1), len(data) - 1)]
        line[np.cumsum(ends - starts + 1) - 1] = 32
        ids = np.array(self.tokenizer.encode_batch_fast([line.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.closes[ids])
        if len(last) != len(starts) or (len(ids) and last[-1] != len(ids) - 1):
            return self._one_by_one(data, starts, ends)
        return ids, np.diff(np.concatenate(([-1], last)))

    def _learn(self, data: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Add pieces that are not known; ``keys`` are their hashes."""
        letter = _KIND[data] == 1
        lead = data == 0xC3
        latin = lead[:-1] & _LATIN[data[1:]]
        letter[:-1] |= latin
        letter[1:] |= latin
        sums = np.concatenate(([0], np.cumsum(letter)))
        plain = sums[ends] - sums[starts] == ends - starts
        for rows, encode in ((np.flatnonzero(plain), self._letters), (np.flatnonzero(~plain), self._one_by_one)):
            if len(rows):
                ids, counts = encode(data, starts[rows], ends[rows])
                self.recent.add(keys[rows], np.arange(self.counts.n, self.counts.n + len(rows)))
                self.starts.add(self.ids.n + np.cumsum(counts) - counts)
                self.counts.add(counts)
                self.ids.add(ids)
        if len(self.recent.keys) > RECENT:
            self.known.add(self.recent.keys, self.recent.values)
            self.recent = _Numbers()

    def _numbers(self, keys: np.ndarray) -> np.ndarray:
        found = self.known.find(keys)
        rest = np.flatnonzero(found < 0)
        found[rest] = self.recent.find(keys[rest])
        return found

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of the slice end to end, and how many each text has."""
        starts, ends = piece_bounds(texts, self.unsplit)
        hashes = segment_hashes(prefix_sums(LOWER[texts.data]), starts, ends)
        order = np.argsort(hashes)
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        first = order[new]
        keys = hashes[first]
        if self.counts.n + len(keys) > MEMORY:
            self.forget()
        found = self._numbers(keys)
        unknown = found < 0
        if unknown.any():
            self._learn(texts.data, keys[unknown], starts[first[unknown]], ends[first[unknown]])
            found[unknown] = self._numbers(keys[unknown])
        number = np.empty(len(hashes), np.int64)
        number[order] = found[np.cumsum(new) - 1]
        counts = self.counts.space[number]
        ids = self.ids.space[ranges(self.starts.space[number], counts)]
        sums = np.concatenate(([0], np.cumsum(counts)))
        return ids, sums[np.searchsorted(starts, texts.ends)] - sums[np.searchsorted(starts, texts.starts)]


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """The worker's encoder for this tokenizer, with what earlier tasks have taught it."""
    return Encoder(path)
