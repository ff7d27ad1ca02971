"""Benchmark decontamination by spaced-seed hashing.

A seed looks at some places of a window of words and ignores the others, by one of a few fixed masks,
so a window still hits where ignored words were substituted. The masks are chosen so that every overlap
by the rule has a hit, wherever its substituted words stand. Tasks hash the windows of the test items under
every mask and store them sorted, in blocks of bounded size in the shared folder. The tasks that read the documents
map one block after another into memory and join their windows by hash. Around every hit the document and the test
item are compared word by word along the diagonal, and the longest stretch in which enough words agree decides.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from tidegauge.llm.files import opened, write_file
from tidegauge.llm.kernel import Words, mix, pieces, ranges, slices, word_hashes
from tidegauge.llm.store import bounded
from tidegauge.scratch import fresh_folder

#: Places that count in a window of words, by mask. In a stretch of 13 to 25 words of which 80 % agree at least
#: one window hits, whichever words differ; a longer one falls into two of which one has the share.
MASKS = ("1101111", "110010001011", "110101011", "1110111")
#: Test items of fewer than ``LEAST_WORDS`` words are looked for whole. Those of fewer than this many are reported
#: apart: so few words stand in many texts that never saw the test.
SHORTEST = 6
#: An overlap is a stretch of so many words, or of the whole item if that is shorter, ...
LEAST_WORDS = 13
#: ... of which at least this share agree.
LEAST_SHARE = 0.8
#: Hashes of test windows in a block, which a task maps into memory at once.
BLOCK = 1_000_000
#: Hits that are followed, and words that are compared around them, at once.
COMPARED = 1_000_000
_FILTER = 1 << 20


def whole_masks(n: int) -> list[str]:
    """Masks over a whole item of ``n`` words; one ignores all words that differ if so few do that the share is kept.

    The places are cut into parts, two more than words may differ, and each mask looks at two of them.
    """
    parts = int(n * (1 - LEAST_SHARE) + 1e-9) + 2
    part = [place * parts // n for place in range(n)]
    return ["".join("1" if p in two else "0" for p in part) for two in combinations(range(parts), 2)]


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the looked-at words of every window; the i-th window begins at word i."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, np.uint64(int(mask, 2)))
    for place, bit in enumerate(mask):
        if bit == "1":
            total = (total + hashes[place : place + n]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
    return mix(total)


def _masks(n: int) -> tuple[str, ...] | list[str]:
    """Masks under which an item of ``n`` words is looked for."""
    return MASKS if n >= LEAST_WORDS else whole_masks(n)


def _portions(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The rows in order, in portions of about ``COMPARED`` by their sizes."""
    turn = np.cumsum(sizes) // COMPARED
    return (rows for rows in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(turn)) + 1) if len(rows))


def block_of(ids: list[int], words: list[np.ndarray]) -> list[np.ndarray]:
    """Arrays of a block in the order in which `Seeds` reads them: windows by hash, then the items."""
    hashed = [(item, seed_hashes(own, mask)) for item, own in enumerate(words) for mask in _masks(len(own))]
    key = np.concatenate([h for _, h in hashed])
    order = np.argsort(key, kind="stable")
    item = np.concatenate([np.full(len(h), i) for i, h in hashed])
    place = np.concatenate([np.arange(len(h)) for _, h in hashed])
    some = np.zeros(_FILTER, np.uint8)
    some[(key & np.uint64(_FILTER - 1)).astype(np.int64)] = 1
    sizes = np.array([len(w) for w in words], np.int64)
    head = np.array([len(key), len(ids), sizes.sum()], np.int64)
    return [head, key[order], np.roll(key, 1)[order], item[order], place[order], np.array(ids, np.int64), sizes, np.concatenate(words), some]


class Seeds:
    """A block of test items by the hashes of their windows, over the bytes of a file."""

    def __init__(self, raw: np.ndarray) -> None:
        n, items, words = raw[:24].view(np.int64).tolist()
        cuts = np.cumsum([24, *(8 * n,) * 4, *(8 * items,) * 2, 8 * words])
        parts = np.split(raw, cuts)[1:]
        # ``before`` is the hash of the window one place earlier in the item.
        self.key, self.before, self.words = (parts[k].view(np.uint64) for k in (0, 1, 6))
        self.item, self.place, self.ids, self.sizes = (parts[k].view(np.int64) for k in (2, 3, 4, 5))
        self.filter = parts[7].view(bool)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.masks = sorted({mask for n in np.unique(self.sizes).tolist() for mask in _masks(n)})

    def hits(self, hashes: np.ndarray, by_mask: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Test item and diagonal (place in the words less place in the item) of every hit, each once.

        ``by_mask`` keeps the window hashes of the words for the blocks to come.
        """
        both = [np.zeros(0, np.int64)]
        for mask in self.masks:
            if mask not in by_mask:
                by_mask[mask] = seed_hashes(hashes, mask)
            hashed = by_mask[mask]
            at = np.flatnonzero(self.filter[(hashed & np.uint64(_FILTER - 1)).astype(np.int64)])
            low, high = np.searchsorted(self.key, hashed[at], "left"), np.searchsorted(self.key, hashed[at], "right")
            hit = high > low
            at, low, count = at[hit], low[hit], (high - low)[hit]
            for part in _portions(count):
                rows, here = ranges(low[part], count[part]), np.repeat(at[part], count[part])
                # The next window along a diagonal that was hit leads to the same comparison.
                place = self.place[rows]
                new = (here == 0) | (place == 0) | (hashed[here - 1] != self.before[rows])
                both.append(np.unique((self.item[rows[new]] << 32) + (here[new] - place[new] + (1 << 31))))
        some = np.unique(np.concatenate(both))
        return some >> 32, (some & 0xFFFFFFFF) - (1 << 31)


def overlaps(agree: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each of the rows, which stand end to end: agreeing words in its longest stretch of at least ``least``
    words of which ``LEAST_SHARE`` agree; 0 if there is none."""
    share = Fraction(str(LEAST_SHARE))
    # A stretch has the share if this running sum does not fall over it; its best start is the earliest lowest one.
    # Every row begins so far below the one before that its earliest start is never looked for there.
    first = np.cumsum(sizes + 1) - (sizes + 1)
    inside = np.ones(len(agree) + len(sizes), bool)
    inside[first] = False
    gain, agreed = np.full(len(inside), -2 * share.denominator * (int(sizes.max(initial=0)) + 1)), np.zeros(len(inside), np.int64)
    gain[inside] = np.where(agree, share.denominator - share.numerator, -share.numerator)
    agreed[inside] = agree
    level, agreed = np.cumsum(gain), np.cumsum(agreed)
    start = np.searchsorted(-np.minimum.accumulate(level), -level, "left")
    length = np.arange(len(level)) - start
    length[length < np.repeat(least, sizes + 1)] = 0
    best = np.maximum.reduceat(length, first)
    ends = np.flatnonzero(length == np.repeat(best, sizes + 1))
    end = ends[np.searchsorted(ends, first)]
    return np.where(best > 0, agreed[end] - agreed[start[end]], 0)


def overlap(agree: np.ndarray, least: int) -> int:
    """`overlaps` of one row."""
    return int(overlaps(agree, np.array([len(agree)]), np.array([least]))[0])


def _compared(seeds: Seeds, words: Words, hashes: np.ndarray, by_mask: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, item and agreeing words of the overlaps along the diagonals with a hit, in portions."""
    items, diagonals = seeds.hits(hashes, by_mask)
    low, high = np.maximum(diagonals, 0), np.minimum(diagonals + seeds.sizes[items], len(hashes))
    # The texts that the diagonal runs over; a window across two texts is cut at the border.
    first, last = np.searchsorted(words.last, low, "right"), np.searchsorted(words.first, high, "left")
    count = np.maximum(last - first, 0)
    text, of = ranges(first, count), np.repeat(np.arange(len(items)), count)
    low, high = np.maximum(low[of], words.first[text]), np.minimum(high[of], words.last[text])
    least = np.minimum(LEAST_WORDS, seeds.sizes[items[of]])
    long = high - low >= least
    text, of, low, size, least = text[long], of[long], low[long], (high - low)[long], least[long]
    own = seeds.begins[items[of]] + low - diagonals[of]
    for rows in _portions(size):
        agree = hashes[ranges(low[rows], size[rows])] == seeds.words[ranges(own[rows], size[rows])]
        starts = np.cumsum(size[rows]) - size[rows]
        likely = np.add.reduceat(agree.astype(np.int64), starts) >= LEAST_SHARE * least[rows] - 1e-9
        agree, rows = agree[np.repeat(likely, size[rows])], rows[likely]
        if len(rows):
            matched = overlaps(agree, size[rows], least[rows])
            yield text[rows[matched > 0]], items[of[rows[matched > 0]]], matched[matched > 0]


def _found(blocks: Blocks, column: pa.Array) -> Iterator[tuple[dict[int, int], set[int]]]:
    """For each text the test items it overlaps, with the number of agreeing words, and the short ones it holds."""
    for texts in slices(column):
        words, hashes = word_hashes(texts)
        out: list[tuple[dict[int, int], set[int]]] = [({}, set()) for _ in texts.ends]
        by_mask: dict[str, np.ndarray] = {}
        for seeds in blocks:
            for text, item, matched in _compared(seeds, words, hashes, by_mask):
                order = np.lexsort((-matched, item, text))
                text, item, matched = text[order], item[order], matched[order]
                most = np.flatnonzero(np.append(True, (np.diff(text) != 0) | (np.diff(item) != 0))[: len(text)])
                for t, i, m in zip(text[most].tolist(), item[most].tolist(), matched[most].tolist(), strict=True):
                    (of, short), key = out[t], int(seeds.ids[i])
                    if seeds.sizes[i] < SHORTEST:
                        short.add(key)
                    elif m > of.get(key, 0):
                        of[key] = m
        yield from out


class Blocks:
    """The stored blocks; going through them maps one at a time."""

    def __init__(self, folder: str, names: list[str]) -> None:
        self.folder, self.names = folder, names
        self.local = isinstance(opened(folder)[0], pafs.LocalFileSystem)

    def __iter__(self) -> Iterator[Seeds]:
        folder = opened(self.folder)[1] if self.local else SparkFiles.get(self.folder.rpartition("/")[2])
        store = pafs.LocalFileSystem(use_mmap=True)
        for name in self.names:
            with store.open_input_file(f"{folder}/{name}") as file:
                yield Seeds(np.frombuffer(file.read_buffer(), np.uint8))


def _stored_blocks(folder: str, limit: int):
    """Write the test items of a task in blocks; their names, new ones at each attempt."""

    def put(ids, words):
        name = uuid.uuid4().hex
        write_file(f"{folder}/{name}", (np.ascontiguousarray(a).view(np.uint8).data for a in block_of(ids, words)))
        return pa.RecordBatch.from_arrays([pa.array([name])], ["name"])

    def run(batches):
        ids: list[int] = []
        words: list[np.ndarray] = []
        size = 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for texts in slices(batch.column(1)):
                of, hashes = word_hashes(texts)
                for row, (first, last) in enumerate(zip(of.first.tolist(), of.last.tolist(), strict=True), texts.first):
                    if last > first:
                        ids.append(keys[row])
                        words.append(hashes[first:last].copy())
                        size += len(_masks(last - first)) * (last - first)
                    if size >= limit:
                        yield put(ids, words)
                        ids, words, size = [], [], 0
        if ids:
            yield put(ids, words)

    return run


def seed_blocks(benchmark: DataFrame) -> Blocks:
    """The test items, stored by tasks in blocks of at most about ``BLOCK`` window hashes; the driver sees file names."""
    spark = benchmark.sparkSession
    folder = fresh_folder(spark, "test-windows")
    rows = benchmark.where("item_id is not null and text is not null").selectExpr("cast(item_id as long) as item_id", "text")
    names = sorted(r["name"] for r in bounded(rows).mapInArrow(_stored_blocks(folder, BLOCK), "name string").collect())
    blocks = Blocks(folder, names)
    if names and not blocks.local:
        spark.sparkContext.addFile(folder, recursive=True)
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``contaminated``, ``n_items``, ``item_ids``, ``agreeing_words``, ``short_item_ids`` for every row of ``docs(doc_id, text)``.

    ``item_ids`` are the test items of ``benchmark(item_id, text)`` that the text overlaps, ascending, and
    ``agreeing_words`` the most words that one of them shares. Items of fewer than ``SHORTEST`` words are looked for by the
    same rule, which lets none of up to four words differ; they are in ``short_item_ids`` and do not make a text contaminated.
    Null and empty texts overlap nothing; so do test items that are null, without words or without an id. An id with
    several texts is found by any. Rows without an id or with a repeated one are judged each. Other columns are not read. An empty
    table gives an empty result; without test items nothing is contaminated. The benchmark is the stated query
    set: one scan of all documents, whose tasks go through its stored blocks.
    """
    kind = "doc_id long, item_ids array<long>, agreeing_words long, short_item_ids array<long>"
    rows = bounded(docs.selectExpr("cast(doc_id as long) as doc_id", "text")).mapInArrow(_marker(seed_blocks(benchmark)), kind)
    return rows.selectExpr("doc_id", "size(item_ids) > 0 as contaminated", "cast(size(item_ids) as long) as n_items", "item_ids", "agreeing_words", "short_item_ids")


def _marker(blocks: Blocks):
    def run(batches):
        ids = pa.list_(pa.int64())
        for batch in pieces(batches, 1):
            found = list(_found(blocks, batch.column(1)))
            items, short = pa.array([sorted(of) for of, _ in found], ids), pa.array([sorted(s) for _, s in found], ids)
            words = pa.array([max(of.values(), default=0) for of, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), items, words, short], ["doc_id", "item_ids", "agreeing_words", "short_item_ids"])

    return run


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no test item of ``SHORTEST`` words or more, with all their columns.

    Nulls, empty texts and tables, repeated rows and rows without an id are judged as in `contamination`.
    """
    return bounded(docs).mapInArrow(_cleaner(seed_blocks(benchmark), docs.columns.index("text")), docs.schema)


def _cleaner(blocks: Blocks, place: int):
    def run(batches):
        for batch in pieces(batches, place):
            yield batch.filter(pa.array([not of for of, _ in _found(blocks, batch.column(place))], pa.bool_()))

    return run
