"""Interpolated modified Kneser-Ney bigram model, counted in Spark and mapped into memory for scoring.

Counting goes through two shuffles. Tasks send distinct words and word pairs of their texts with
counts; pairs are dealt out by their own hash, so a frequent word is spread like any other. Each
share of pairs is written as one sorted array of hashes with counts. It passes on, per word, how
many words it follows and how its own successors are distributed, which meet the word counts in the
second shuffle and are written likewise. The driver receives a few sums.

Workers map the arrays and look hashes up in ascending order. Files lie in the shared folder; from a
store that has no paths Spark brings them to each executor.
"""

from __future__ import annotations

import mmap
import resource
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.files import opened, write_file
from tidegauge.llm.kernel import Texts, mix, pieces, slices, word_hashes
from tidegauge.llm.store import bounded, stored
from tidegauge.scratch import fresh_folder

#: Stand before the first and after the last word of a text; no word has these hashes by design.
BEGIN, END = np.uint64(0x0B0E0B0E0B0E0000), np.uint64(0xE4DE4DE4DE4DE4D0)
#: Word pairs a task holds before it sends them.
HELD = 1_500_000
#: In pairs, words are told apart by so many bits of their hash.
WORD_BITS = 48
_CUT = np.uint64(64 - WORD_BITS)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Smoothing(NamedTuple):
    """Sums over the corpus."""

    tokens: int
    types: int
    pair_types: int
    discounts: np.ndarray  # of pairs seen once, twice, more often
    word_discounts: np.ndarray  # the same for words by the number of words they follow
    word_back: float  # weight of the uniform distribution


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left >> _CUT) * _FACTOR + (right >> _CUT))


def token_stream(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts, each text's words and then ``END``; the token before each; first token of each text."""
    words, hashes = word_hashes(texts)
    counts = words.last - words.first
    ends = np.cumsum(counts + 1) - 1
    tokens = np.empty(len(hashes) + len(counts), np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = END, hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    starts = ends - counts
    before[starts] = BEGIN
    return tokens, before, starts


def _shares(keys: np.ndarray, count: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys ascending, the place of one occurrence of each, and sums of the values."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return keys, at, *values
    return ordered[at], order[at], *(np.add.reduceat(v[order], at) for v in values)


def _six(values: np.ndarray) -> bytes:
    """The upper six bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _from_six(blob: bytes) -> np.ndarray:
    some = np.frombuffer(blob, np.uint8).reshape(-1, 6)
    full = np.zeros((len(some), 8), np.uint8)
    full[:, 2:] = some
    return full.view("<u8").ravel()


def _cut(shares: np.ndarray) -> list[tuple[int, int, int]]:
    values, lows = np.unique(shares, return_index=True)
    return list(zip(values.tolist(), lows.tolist(), [*lows[1:].tolist(), len(shares)], strict=True))


_COUNTED = "words boolean, share long, a binary, b binary, n binary"


def _count(shares: int):
    def sent(words, pairs):
        key, n = (np.concatenate(x) for x in zip(*words, strict=True))
        key, _, n = _summed(key, n)
        for share, a, b in _cut(_shares(key, shares)):
            yield {"words": True, "share": share, "a": key[a:b].tobytes(), "b": b"", "n": n[a:b].astype("<u4").tobytes()}
        left, right, n = (np.concatenate(x) for x in zip(*pairs, strict=True))
        key, at, n = _summed(pair_hash(left, right), n)
        left, right = left[at], right[at]
        for share, a, b in _cut(_shares(key, shares)):
            yield {"words": False, "share": share, "a": _six(left[a:b]), "b": _six(right[a:b]), "n": n[a:b].astype("<u4").tobytes()}

    def run(batches):
        words, pairs, held = [], [], 0
        kind = pa.schema([("words", pa.bool_()), ("share", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("n", pa.binary())])
        for batch in pieces(batches, 1):
            for texts in slices(batch.column(1)):
                tokens, before, _ = token_stream(texts)
                key, _, n = _summed(tokens, np.ones(len(tokens), np.int64))
                words.append((key, n))
                key, at, n = _summed(pair_hash(before, tokens), np.ones(len(tokens), np.int64))
                pairs.append((before[at], tokens[at], n))
                held += len(key)
            if held >= HELD:
                for row in sent(words, pairs):
                    yield pa.RecordBatch.from_pylist([row], kind)
                words, pairs, held = [], [], 0
        if held:
            for row in sent(words, pairs):
                yield pa.RecordBatch.from_pylist([row], kind)

    return run


def _four(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4."""
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].tolist()


_PASSED = "share long, key binary, follows binary, total binary, once binary, twice binary, more binary, types long, four array<long>"


def _pairs_of_share(folder: str, shares: int):
    def run(table: pa.Table) -> pa.Table:
        left, right = (np.concatenate([_from_six(x) for x in table[c].to_pylist()]) for c in "ab")
        n = np.frombuffer(b"".join(table["n"].to_pylist()), "<u4").astype(np.int64)
        key, at, n = _summed(pair_hash(left, right), n)
        left, right = left[at], right[at]
        write_file(f"{folder}/pairs-{table['share'][0].as_py():06d}", [key.tobytes(), n.astype("<u4").tobytes()])
        one = np.ones(len(n), np.int64)
        # The successors of each word, and how many words each follows.
        heads, _, total, once, twice, more = _summed(left, n, (n == 1) * one, (n == 2) * one, (n > 2) * one)
        tails, _, follows = _summed(right, one)
        both = np.union1d(heads, tails)
        columns = {c: np.zeros(len(both), "<u4") for c in ("follows", "total", "once", "twice", "more")}
        columns["follows"][np.searchsorted(both, tails)] = follows
        for c, v in (("total", total), ("once", once), ("twice", twice), ("more", more)):
            columns[c][np.searchsorted(both, heads)] = v
        rows = [
            {"share": share, "key": _six(both[a:b]), **{c: v[a:b].tobytes() for c, v in columns.items()}, "types": len(n) if not i else 0, "four": _four(n) if not i else [0] * 4}
            for i, (share, a, b) in enumerate(_cut(_shares(both, shares)))
        ]
        return pa.Table.from_pylist(rows)

    return run


_FIELDS = ("count", "follows", "total", "once", "twice", "more")


def _words_of_share(folder: str):
    def run(table: pa.Table) -> pa.Table:
        counted = table.filter(table["words"])
        key = np.frombuffer(b"".join(counted["a"].to_pylist()), np.uint64)
        key, _, count = _summed(key, np.frombuffer(b"".join(counted["n"].to_pylist()), "<u4").astype(np.int64))
        rest = table.filter(pa.array([not w for w in table["words"].to_pylist()]))
        short = np.concatenate([_from_six(x) for x in rest["key"].to_pylist()] or [np.zeros(0, np.uint64)])
        sums = [np.frombuffer(b"".join(rest[c].to_pylist()), "<u4").astype(np.int64) for c in _FIELDS[1:]]
        short, _, *sums = _summed(short, *sums)
        # Pairs know words by fewer bits; what is no counted word is the beginning of a text.
        own = key >> _CUT << _CUT
        key = np.sort(np.concatenate((key, np.setdiff1d(short, own))))
        values = np.zeros((len(_FIELDS), len(key)), "<u4")
        values[0, np.isin(key >> _CUT << _CUT, own)] = count
        at = np.searchsorted(short, key >> _CUT << _CUT)
        found = at < len(short)
        found[found] = short[at[found]] == (key >> _CUT << _CUT)[found]
        for i, v in enumerate(sums, 1):
            values[i, found] = v[at[found]]
        write_file(f"{folder}/words-{table['share'][0].as_py():06d}", [key.tobytes(), values.tobytes()])
        follows = values[1].astype(np.int64)
        return pa.Table.from_pylist([{"tokens": int(values[0].sum(dtype=np.int64)), "types": int((values[0] > 0).sum()), "three": [int((follows == 1).sum()), int((follows == 2).sum()), int((follows > 2).sum())], "four": _four(follows)}])

    return run


def discounts(four: list[int]) -> np.ndarray:
    """Discounts of counts 1, 2 and 3 or more from how many counts are 1 to 4; within their bounds where those are rare."""
    n = [float(x) for x in four]
    if n[0] + 2 * n[1] == 0:
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k * y for k in (1, 2, 3)]
    return np.array([min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)])


def trained(docs: DataFrame) -> tuple[str, int, Smoothing]:
    """Count all texts of ``docs(doc_id, text)``: the folder of the arrays, their number, and the sums."""
    spark = docs.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = fresh_folder(spark, "language-model")
    counted = bounded(docs.select("doc_id", "text")).mapInArrow(_count(shares), _COUNTED)
    # One task of pairs is one share: a share's array is written whole.
    words = stored(counted.where("words"), "word-counts")
    passed = stored(counted.where("not words").groupBy("share").applyInArrow(_pairs_of_share(folder, shares), _PASSED), "successors")
    pair = passed.agg(F.sum("types").alias("types"), *(F.sum(F.col("four")[i]).alias(f"n{i}") for i in range(4))).first()
    gathered = words.select("words", "share", "a", "n").unionByName(passed.withColumn("words", F.lit(False)).drop("types", "four"), allowMissingColumns=True)
    sums = gathered.groupBy("share").applyInArrow(_words_of_share(folder), "tokens long, types long, three array<long>, four array<long>")
    word = sums.agg(
        F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), *(F.sum(F.col("three")[i]).alias(f"t{i}") for i in range(3)), *(F.sum(F.col("four")[i]).alias(f"n{i}") for i in range(4))
    ).first()
    pair_types = pair["types"] or 0
    by_word = discounts([word[f"n{i}"] or 0 for i in range(4)])
    back = float(by_word @ np.array([word[f"t{i}"] or 0 for i in range(3)]) / pair_types) if pair_types else 1.0
    return folder, shares, Smoothing(word["tokens"] or 0, word["types"] or 0, pair_types, discounts([pair[f"n{i}"] or 0 for i in range(4)]), by_word, back)


def _mapped(path: str) -> np.ndarray:
    """The bytes of a file, mapped into memory without a file handle that stays open: models have thousands of files."""
    with open(path, "rb") as file:
        try:
            return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False), np.uint8)
        except TypeError:  # before Python 3.13 a handle is kept
            limit = resource.getrlimit(resource.RLIMIT_NOFILE)[1]
            resource.setrlimit(resource.RLIMIT_NOFILE, (limit, limit))
            return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)


class Arrays:
    """The sorted arrays, mapped into memory as far as they are looked at."""

    def __init__(self, folder: str, shares: int) -> None:
        self.folder, self.shares, self.open = folder, shares, {}

    def _shard(self, kind: str, share: int):
        if (kind, share) not in self.open:
            store, path = opened(f"{self.folder}/{kind}-{share:06d}")
            if store.get_file_info(path).type == pafs.FileType.NotFound:
                self.open[kind, share] = None
            else:
                raw = _mapped(path)
                fields = 1 if kind == "pairs" else len(_FIELDS)
                n = len(raw) // (8 + 4 * fields)
                self.open[kind, share] = raw[: 8 * n].view(np.uint64), raw[8 * n :].view("<u4").reshape(fields, n)
        return self.open[kind, share]

    def find(self, kind: str, keys: np.ndarray) -> np.ndarray:
        """Fields of ascending distinct keys, one column each; zeros where a key is absent."""
        out = np.zeros((1 if kind == "pairs" else len(_FIELDS), len(keys)), np.int64)
        for share, a, b in _cut(_shares(keys, self.shares)):
            shard = self._shard(kind, share)
            if shard is not None and len(shard[0]):
                at = np.minimum(np.searchsorted(shard[0], keys[a:b]), len(shard[0]) - 1)
                hit = shard[0][at] == keys[a:b]
                out[:, a:b][:, hit] = shard[1][:, at[hit]]
        return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def _score(folder: str, local: bool, shares: int, s: Smoothing):
    def run(batches):
        arrays = Arrays(folder if local else SparkFiles.get(folder.rpartition("/")[2]), shares)
        pair_cut, word_cut = np.append(0.0, s.discounts), np.append(0.0, s.word_discounts)
        for batch in pieces(batches, 1):
            out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score")}
            for texts in slices(batch.column(1)):
                tokens, before, starts = token_stream(texts)
                words, of = _distinct(np.concatenate((tokens, [BEGIN])))
                count, follows, total, once, twice, more = arrays.find("words", words)
                known = count > 0
                base = np.log10((count + 1) / (s.tokens + s.types + 1))
                lower = np.maximum(follows - word_cut[np.minimum(follows, 3)], 0) / max(s.pair_types, 1) + s.word_back / (s.types + 1)
                weight = s.discounts[0] * once + s.discounts[1] * twice + s.discounts[2] * more
                pairs, of_pair = _distinct(pair_hash(before, tokens))
                seen = arrays.find("pairs", pairs)[0]
                kept = (seen - pair_cut[np.minimum(seen, 3)])[of_pair]
                token = of[:-1]
                place = np.searchsorted(words, before)
                after = total[place]
                chance = np.where(after > 0, (kept + weight[place] * lower[token]) / np.maximum(after, 1), lower[token])
                ends = np.append(starts[1:], len(tokens))
                out["n_tokens"].append(ends - starts)
                for name, values in (("n_known", known[token].astype(np.int64)), ("base_score", base[token]), ("score", np.log10(chance))):
                    out[name].append(np.add.reduceat(values, starts))
            columns = [pa.array(np.concatenate(v)) for v in out.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), *columns, pa.array(np.full(batch.num_rows, s.tokens))], ["doc_id", "held_out", *out, "train_tokens"])

    return run


def scored(docs: DataFrame, model: tuple[str, int, Smoothing]) -> DataFrame:
    """Score all texts of ``docs(doc_id, text, held_out)`` with a trained model."""
    folder, shares, smoothing = model
    local = isinstance(opened(folder)[0], pafs.LocalFileSystem)
    if not local:
        docs.sparkSession.sparkContext.addFile(folder, recursive=True)
    rows = bounded(docs.select("doc_id", "text", "held_out"))
    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, train_tokens long"
    return rows.mapInArrow(_score(folder, local, shares, smoothing), kind)


def language_model_scores(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Train on rows whose ``crc32(doc_id)`` modulo ``folds`` is not ``held``; score every row.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams plus
    one) and ``score`` (the model), both as log10 probability. A null or empty text has one token, its
    end. Rows without an id are trained on and scored. Rows that repeat count as often as they
    stand. With nothing to train on all tokens are unknown and share one probability. Other columns are not
    read. An empty table gives an empty result.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    rows = docs.select("doc_id", "text", F.coalesce(fold == held, F.lit(False)).alias("held_out"))
    return scored(rows, trained(rows.where("not held_out")))
