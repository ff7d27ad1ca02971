"""Spelling variants: words one edit apart, found by probing generated edits against Bloom filters.

1. Words are counted in Spark. The vocabulary, words that occur often enough, is stored with a 64-bit key a word.
2. Blocked Bloom filters over the keys, a shard for each word length, are built in Spark and broadcast. They have a
   fixed size limit. A larger vocabulary is taken in rounds, each with the filter of one residue of the keys.
3. Every word's deletions and replacements are hashed from sums over its letters, a few vector operations
   for all words of one length, and probed in the shard of the edit's length. An insertion is another word's
   deletion, and of two words a replacement apart one has the larger letter, so each pair comes up once.
4. Only positives are shuffled, as two keys of eight bytes. Joins with the vocabulary give the words behind the
   keys, and comparing the words themselves removes false positives and equal keys of different words.
5. Roots follow the forms by doubling: a form occurs ``RATIO`` times as often as its word, so a chain is
   as long as the logarithm of the largest count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.kernel import mix
from tidegauge.llm.store import bounded, stored

LEAST_LETTERS = 6
LEAST_COUNT = 5
#: A word's form occurs at least so many times as often.
RATIO = 5
#: One in so many occurrences, by its hash, is read with one letter missing.
SLIP = 199
#: Words of at least so many letters share a shard.
LONGEST = 64
BITS_A_WORD = 16
#: Limit of a broadcast filter.
FILTER_BYTES = 1 << 25
#: Words that one task probes.
PROBED = 20_000
#: Edits that are hashed at once.
EDITS = 1 << 20

_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_LETTERS = np.random.Generator(np.random.PCG64(20250611)).integers(1, 1 << 63, 256, dtype=np.uint64)
_LENGTH = 0xC2B2AE3D27D4EB4F


def counted_words(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of all words that are long and frequent enough."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(_RUN), F.lit(0))).alias("run"))
    # Runs that are too short even whole are no words.
    runs = runs.where(F.length("run") >= LEAST_LETTERS)
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _LOWER)).otherwise(F.col("run"))
    runs = runs.select("id", lowered.alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_COUNT)


class Words(NamedTuple):
    """Words of one length: their rows in the batch, and their letters as a matrix."""

    rows: np.ndarray
    letters: np.ndarray

    def powers(self) -> np.ndarray:
        out = np.full(self.letters.shape[1], np.uint64(_BASE))
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def terms(self) -> np.ndarray:
        return _LETTERS[self.letters] * self.powers()


def by_length(words: list[str]) -> Iterator[Words]:
    """The words, in blocks of one length and of bounded size; all their letters are below 256."""
    data = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, EDITS // (int(length) * 64))
        for low in range(0, len(rows), step):
            some = rows[low : low + step]
            yield Words(some, data[starts[some][:, None] + np.arange(length)])


def keys_of(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + np.uint64(length * _LENGTH % (1 << 64)))


def edits(words: Words, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Rows of the block, keys and length of every deletion, and of every replacement by a larger letter of the sorted alphabet."""
    letters = words.letters
    length = letters.shape[1]
    terms, powers = words.terms(), words.powers()
    before = np.cumsum(terms, axis=1, dtype=np.uint64)
    total = before[:, -1]
    # Deleting one letter of a run of equal ones gives the same word each time: the first is taken.
    first = np.ones(letters.shape, bool)
    first[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, place = np.nonzero(first)
    left = before[row, place] - terms[row, place]
    yield row, keys_of(left + (total[row] - before[row, place]) * _INVERSE, length - 1), length - 1
    step = max(1, EDITS // (len(letters) * max(len(alphabet), 1)))
    for low in range(0, length, step):
        part = letters[:, low : low + step]
        row, place, new = np.nonzero(alphabet[None, None, :] > part[:, :, None])
        old = part[row, place]
        moved = (_LETTERS[alphabet[new]] - _LETTERS[old]) * powers[low + place]
        yield row, keys_of(total[row] + moved, length), length


class Shards(NamedTuple):
    """Where the shard of each length begins among the 64-bit blocks of a filter, and its number of blocks."""

    starts: np.ndarray
    sizes: np.ndarray
    rounds: int

    @property
    def blocks(self) -> int:
        return int(self.sizes.sum())

    def place(self, keys: np.ndarray, length: int) -> np.ndarray:
        shard = min(length, LONGEST)
        inside = ((keys >> np.uint64(32)) * self.sizes[shard].astype(np.uint64)) >> np.uint64(32)
        return self.starts[shard] + inside.astype(np.int64)

    def mine(self, keys: np.ndarray, turn: int) -> np.ndarray:
        return keys % np.uint64(self.rounds) == np.uint64(turn) if self.rounds > 1 else np.ones(len(keys), bool)


def planned(counts: dict[int, int], limit: int = FILTER_BYTES) -> Shards:
    """Shards for so many words of each length; with more than fit into the limit, rounds over residues of the keys."""
    needed = sum(counts.values()) * BITS_A_WORD / 8
    rounds = max(1, math.ceil(needed / limit))
    sizes = np.zeros(LONGEST + 1, np.int64)
    for shard, n in counts.items():
        sizes[shard] = math.ceil(n * BITS_A_WORD / rounds / 64)
    return Shards(np.cumsum(sizes) - sizes, sizes, rounds)


def _marks(keys: np.ndarray) -> np.ndarray:
    """The four bits of a key in its block."""
    bits = np.zeros(len(keys), np.uint64)
    for shift in (0, 6, 12, 18):
        bits |= np.uint64(1) << ((keys >> np.uint64(shift)) & np.uint64(63))
    return bits


def _keyed(batches):
    for batch in batches:
        words = batch.column(0).to_pylist()
        keys = np.zeros(len(words), np.uint64)
        for block in by_length(words):
            keys[block.rows] = keys_of(block.terms().sum(axis=1, dtype=np.uint64), block.letters.shape[1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], [*batch.schema.names, "key"])


def filter_of(vocabulary: DataFrame, shards: Shards, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of one round's filter, and the letters that occur, ascending. The driver sees at most ``FILTER_BYTES`` of blocks."""
    blocks = shards.blocks

    def parts(batches):
        bits, seen = np.zeros(blocks, np.uint64), np.zeros(256, bool)
        for batch in batches:
            for block in by_length(batch.column(0).to_pylist()):
                seen[block.letters] = True
                length = block.letters.shape[1]
                keys = keys_of(block.terms().sum(axis=1, dtype=np.uint64), length)
                keys = keys[shards.mine(keys, turn)]
                np.bitwise_or.at(bits, shards.place(keys, length), _marks(keys))
        used = np.flatnonzero(bits)
        letters = np.packbits(seen).view(np.int64)
        places = np.concatenate((used, blocks + np.arange(4)))
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.concatenate((bits[used].view(np.int64), letters)))], ["place", "bits"])

    found = vocabulary.select("word").mapInArrow(parts, "place long, bits long").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(blocks + 4, np.int64)
    out[found["place"].to_numpy()] = found["bits"].to_numpy()
    return out[:blocks].view(np.uint64), np.flatnonzero(np.unpackbits(out[blocks:].view(np.uint8))).astype(np.uint8)


def _positives(shared, shards: Shards, turn: int):
    def run(batches):
        bits, alphabet = shared.value
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False)
            for block in by_length(batch.column(0).to_pylist()):
                rows, found = [], []
                for row, keys, length in edits(block, alphabet):
                    if not shards.sizes[min(length, LONGEST)]:
                        continue
                    mine = np.flatnonzero(shards.mine(keys, turn))
                    keys = keys[mine]
                    marks = _marks(keys)
                    hit = np.flatnonzero(bits[shards.place(keys, length)] & marks == marks)
                    rows.append(row[mine[hit]])
                    found.append(keys[hit])
                if rows:
                    # Two edits of a word with one key would make a pair twice.
                    pairs = np.unique(np.stack((np.concatenate(rows).astype(np.uint64), np.concatenate(found))), axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(own[block.rows[pairs[0].astype(np.int64)]]), pa.array(pairs[1].view(np.int64))], ["word_key", "edit_key"])

    return run


def near_pairs(vocabulary: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """``a``, ``a_n``, ``b``, ``b_n``: each unordered pair of words of ``vocabulary(word, n, key)`` that are one edit apart, once."""
    spark = vocabulary.sparkSession
    counts = {r["shard"]: r["n"] for r in vocabulary.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shards = planned(counts, limit)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sum(counts.values()) // PROBED))
    rounds = []
    for turn in range(shards.rounds):
        shared = spark.sparkContext.broadcast(filter_of(vocabulary, shards, turn))
        probed = vocabulary.select("word", "key").repartition(tasks, "key").mapInArrow(_positives(shared, shards, turn), "word_key long, edit_key long")
        rounds.append(stored(probed, "positives"))
        shared.destroy()
    positives = rounds[0]
    for more in rounds[1:]:
        positives = positives.union(more)
    a = vocabulary.select(F.col("key").alias("word_key"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = vocabulary.select(F.col("key").alias("edit_key"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    return positives.join(b, "edit_key").join(a, "word_key").where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def _forms(pairs: DataFrame) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` of words that have near ones."""
    names = ("word", "n", "near", "near_n")
    sides = F.array(*(F.struct(*(F.col(c).alias(name) for c, name in zip(columns, names, strict=True))) for columns in (("a", "a_n", "b", "b_n"), ("b", "b_n", "a", "a_n"))))
    both = pairs.select(F.explode(sides).alias("s")).select("s.*")
    best = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    often = -F.col("best.less") >= RATIO * F.col("n")

    def if_often(value: Column) -> Column:
        return F.when(often, value)

    return best.select("word", "n", "n_near", if_often(F.col("best.near")).alias("form"), if_often(-F.col("best.less")).alias("form_n"))


def _rooted(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for words that have a form: forms are followed to the last, twice as far each round."""
    chain = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "chain")
    longest = forms.agg(F.max("form_n").alias("n")).collect()[0]["n"] or 1
    steps = math.log(max(longest / LEAST_COUNT, 1), RATIO) + 1
    for _ in range(math.ceil(math.log2(steps + 1))):
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("further"))
        chain = stored(chain.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "chain")
    return chain


def spelling_variants(docs: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` for every word of the vocabulary of ``docs(doc_id, text)``.

    Words are the runs of letters, A-Z lowered, of at least ``LEAST_LETTERS`` code points that occur at least ``LEAST_COUNT``
    times, after one letter was taken out of each occurrence whose hash with the id ``SLIP`` divides. A word's form is its most
    frequent near word, of several the first in code-point order, if it occurs ``RATIO`` times as often; the root is
    the last in the chain of forms, or the word itself. Null texts have no words; a null id hashes as an empty one. Rows that
    repeat count each. Other columns are not read. An empty table, or one without frequent words, gives an empty result.
    """
    vocabulary = stored(bounded(docs).transform(counted_words).mapInArrow(_keyed, "word string, n long, key long"), "vocabulary")
    forms = stored(_forms(near_pairs(vocabulary, limit)), "forms")
    rows = vocabulary.select("word", "n").join(forms.drop("n"), "word", "left").join(_rooted(forms), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
