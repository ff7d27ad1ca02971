"""Repeated byte strings across documents: depth-limited radix sort of suffixes.

Only suffixes that can repeat are sorted. Every string of ``LENGTH`` bytes is keyed by the least hash
among its ``GRAM``-byte substrings, so equal strings have equal keys, and neighbouring strings with the
same key form one segment of text. Rows are stored once with a unit, the partition that wrote them. Units
are part of the data from then on: whichever tasks read the rows, and in whatever portions, a row belongs to the unit it
was stored with. Four passes, of which the stored rows are read in three:

1. Each unit sends its distinct keys, six bytes each. A key that two documents
   have is sent back to the units that have it, and whether it has many windows in all.
2. Each unit sends its distinct segments under those keys, with the smallest and largest id. Under a key
   with many windows each window is a segment of its own and is dealt out by its hash.
3. Per key, segments meet. A key with one distinct segment is settled. Otherwise the suffixes at its
   windows are ordered by most-significant-digit passes, eight bytes a digit, and no further than
   ``LENGTH`` bytes: groups that stay equal are exactly the repeated strings. The smallest id of each
   group is sent back as runs of windows.
4. Units cover the bytes of windows whose smallest id is below the document's own.

Inside a passage that a third of all documents have, a unit has one segment. At the edges of the passage
segments reach into each document's own text and are as many as documents, all under one key; there
only equal windows meet. Memory of a task is bounded by its unit, and by its share of keys. Shares are so many
that each has the keys of about ``SHARE_BYTES`` of stored rows, whatever the number of shuffle partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.files import read_unit
from tidegauge.llm.kernel import Texts, mix, pieces, prefix_sums, ranges, segment_hashes, slices
from tidegauge.llm.store import bounded
from tidegauge.scratch import fresh_folder

LENGTH = 50
GRAM = 20
#: Keys are compared by so many of their bits between documents; more only spares work.
KEY_BITS = 48
#: Shares of keys for each shuffle partition at least; a task takes them one at a time.
SHARES = 4
#: Stored rows for each share of keys.
SHARE_BYTES = 2_000_000
#: A key with so many windows in all documents is taken apart: its windows are compared by key and hash.
HOT = 200_000
#: A unit says how many windows a key has from so many on.
OFTEN = 256
#: Single windows that a unit gathers before it sends them.
GATHERED = 500_000
_LOW_BITS = np.uint64(64 - KEY_BITS)


def _gram_values(sums: np.ndarray, n: int) -> np.ndarray:
    starts = np.arange(n - GRAM + 1)
    return segment_hashes(sums, starts, starts + GRAM)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    done = 1
    least = values
    while 2 * done <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    return np.minimum(least[: len(least) - (width - done)], least[width - done :]) if done < width else least


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


class Segments:
    """Runs of windows with one key in some texts: first byte, number of windows, key, text number."""

    def __init__(self, texts: Texts) -> None:
        data, n = texts.data, len(texts.data)
        none = np.zeros(0, np.int64)
        self.first = self.windows = self.text = none
        self.key = none.astype(np.uint64)
        self.sums = prefix_sums(data)
        if n < LENGTH:
            return
        least = _least_of(_gram_values(self.sums, n), LENGTH - GRAM + 1)
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        good = np.ones(len(least), bool)
        starts, ends = texts.starts, texts.ends
        # Windows that reach over the end of their text.
        low, high = np.maximum(starts, ends - LENGTH + 1), np.minimum(ends, len(least))
        good[ranges(low, np.maximum(high - low, 0))] = False
        inner = starts[(starts < len(least)) & (ends > starts)]
        new[inner] = True
        new &= good
        # A window that cannot be used ends a run as well.
        stop = np.flatnonzero(new | ~good)
        self.first = np.flatnonzero(new)
        after = np.append(stop, len(least))[np.searchsorted(stop, self.first, "right")]
        self.windows = after - self.first
        self.key = mix(least[self.first])
        self.text = np.searchsorted(ends, self.first, "right")

    def split(self, hot: np.ndarray) -> None:
        """Make each window under one of the sorted short keys a segment of its own."""
        chosen = _among(self.key >> _LOW_BITS, hot)
        if not chosen.any():
            return
        count = np.where(chosen, self.windows, 1)
        of = np.repeat(np.arange(len(count)), count)
        self.first = ranges(self.first, count)
        self.windows = np.where(chosen, 1, self.windows)[of]
        self.key, self.text = self.key[of], self.text[of]

    def names(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """A number for key and text of the segment together."""
        first, windows = self.first[rows], self.windows[rows]
        return mix(self.key[rows] + segment_hashes(self.sums, first, first + windows + LENGTH - 1))


def _parts_of_units(batches) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The batches cut where the unit, the last column, changes."""
    for batch in batches:
        units = batch.column(2).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(units)) + 1).tolist(), len(units)] if len(units) else []
        for low, high in zip(cuts, cuts[1:], strict=False):
            yield int(units[low]), batch.slice(low, high - low)


def _each_unit(work: Callable):
    """``work`` on the rows of one unit after the other; a unit read by two tasks is two parts of it."""

    def run(batches):
        for unit, parts in groupby(_parts_of_units(batches), itemgetter(0)):
            yield from work(unit, map(itemgetter(1), parts))

    return run


def _scanned(batches):
    """Segments of a partition's texts, slice by slice, with the ids; rows without an id are left out."""
    for batch in pieces(batches, 1):
        batch = batch.filter(batch.column(0).is_valid())
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for texts in slices(batch.column(1)):
            yield ids[texts.first : texts.first + len(texts.ends)], texts, Segments(texts)


def _shares(keys: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` equal ranges of the key space each key falls into."""
    return ((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)


def _cuts(shares: np.ndarray) -> list[tuple[int, int, int]]:
    """Bounds of the stretches of equal values in sorted shares."""
    if not len(shares):
        return []
    at = np.flatnonzero(np.diff(shares)) + 1
    lows, highs = np.concatenate(([0], at)), np.append(at, len(shares))
    return [(int(shares[a]), int(a), int(b)) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)]


def _bounds(order_key: np.ndarray) -> np.ndarray:
    """Where each stretch of equal values begins."""
    new = np.ones(len(order_key), bool)
    new[1:] = order_key[1:] != order_key[:-1]
    return np.flatnonzero(new)


def _send_keys(count: int, often: int):
    def run(unit, batches):
        keys, least, most, windows = [], [], [], []
        for ids, _, segments in _scanned(batches):
            key, doc = segments.key >> _LOW_BITS, ids[segments.text]
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            at = _bounds(key)
            if len(at):
                keys.append(key[at])
                least.append(np.minimum.reduceat(doc, at))
                most.append(np.maximum.reduceat(doc, at))
                windows.append(np.add.reduceat(segments.windows[order], at).astype(np.uint32))
        if not keys:
            return
        key, low, high, total = (np.concatenate(x) for x in (keys, least, most, windows))
        keys, least, most, windows = [], [], [], []
        order = np.argsort(key, kind="stable")
        key, at = key[order], _bounds(key[order])
        shared = np.minimum.reduceat(low[order], at) != np.maximum.reduceat(high[order], at)
        key, total = key[at], np.add.reduceat(total[order], at, dtype=np.int64)
        for share, a, b in _cuts(_shares(key << _LOW_BITS, count)):
            many = np.flatnonzero(total[a:b] >= often)
            packed = np.ascontiguousarray(key[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8])
            yield pa.RecordBatch.from_pylist([{"share": share, "unit": unit, "keys": packed.tobytes(), "shared": np.packbits(shared[a:b]).tobytes(), "many": many.tobytes(), "windows": total[a:b][many].tobytes()}])

    return _each_unit(run)


def _unpacked(blob: bytes) -> np.ndarray:
    some = np.frombuffer(blob, np.uint8).reshape(-1, KEY_BITS // 8)
    full = np.zeros((len(some), 8), np.uint8)
    full[:, : KEY_BITS // 8] = some
    return full.view("<u8").ravel().astype(np.uint64)


def _repeated_keys(hot: int):
    def run(table: pa.Table) -> pa.Table:
        """For one share: each unit's keys that another document has as well, and which of them have ``hot`` windows."""
        units, rows = table["unit"].to_pylist(), [_unpacked(k) for k in table["keys"].to_pylist()]
        shared = [np.unpackbits(np.frombuffer(s, np.uint8), count=len(r)).astype(bool) for s, r in zip(table["shared"].to_pylist(), rows, strict=True)]
        values, counts = np.unique(np.concatenate(rows), return_counts=True)
        repeated = np.union1d(values[counts > 1], np.concatenate([r[s] for r, s in zip(rows, shared, strict=True)]))
        found = [r[np.isin(r, repeated, assume_unique=True)] for r in rows]
        many = np.concatenate([r[np.frombuffer(m, np.int64)] for r, m in zip(rows, table["many"].to_pylist(), strict=True)])
        windows = np.frombuffer(b"".join(table["windows"].to_pylist()), np.int64)
        order = np.argsort(many, kind="stable")
        at = _bounds(many[order])
        large = many[order][at][np.add.reduceat(windows[order], at) >= hot] if len(at) else many
        return pa.table(
            {
                "unit": pa.array(units, pa.int64()),
                "keys": pa.array([f.astype("<u8").tobytes() for f in found], pa.binary()),
                "hot": pa.array([f[_among(f, large)].astype("<u8").tobytes() for f in found], pa.binary()),
            }
        )

    return run


def _answered(replies: str, unit: int, column: str) -> np.ndarray:
    """The sorted keys that a unit was sent: all of ``keys``, or those of them that are ``hot``."""
    table = read_unit(replies, unit)
    return np.sort(np.frombuffer(b"" if table is None else b"".join(table[column].to_pylist()), "<u8"))


def _single_windows(unit: int, count: int, parts: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Windows dealt out by name to the ``count`` shares after those of keys; they have no size, and their names are the data."""
    key, name, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(name, kind="stable")
    at = _bounds(name[order])
    key, name, low, high = key[order][at], name[order][at], np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)
    for share, a, b in _cuts(_shares(name, count)):
        yield pa.RecordBatch.from_pylist(
            [{"share": count + share, "unit": unit, "keys": key[a:b].tobytes(), "sizes": b"", "least": low[a:b].tobytes(), "most": high[a:b].tobytes(), "data": name[a:b].tobytes()}]
        )


def _send_segments(count: int, replies: str):
    def run(unit, batches):
        wanted, hot = (_answered(replies, unit, column) for column in ("keys", "hot"))
        if not len(wanted):
            return
        single: list[tuple] = []
        names, keys, least, most, lengths, texts_of = [], [], [], [], [], []
        for ids, texts, segments in _scanned(batches):
            segments.split(hot)
            rows = np.flatnonzero(_among(segments.key >> _LOW_BITS, wanted))
            if not len(rows):
                continue
            name, doc = segments.names(rows), ids[segments.text[rows]]
            order = np.argsort(name, kind="stable")
            at = _bounds(name[order])
            one, name = rows[order[at]], name[order][at]
            low, high = np.minimum.reduceat(doc[order], at), np.maximum.reduceat(doc[order], at)
            apart = _among(segments.key[one] >> _LOW_BITS, hot)
            if apart.any():
                single.append((segments.key[one[apart]], name[apart], low[apart], high[apart]))
                if sum(len(x[0]) for x in single) >= GATHERED:
                    yield from _single_windows(unit, count, single)
                    single = []
            one, whole = one[~apart], ~apart
            names.append(name[whole])
            keys.append(segments.key[one])
            least.append(low[whole])
            most.append(high[whole])
            size = segments.windows[one] + LENGTH - 1
            lengths.append(size)
            texts_of.append(texts.data[ranges(segments.first[one], size)])
        if single:
            yield from _single_windows(unit, count, single)
        if not sum(map(len, names)):
            return
        name, key, low, high, size = (np.concatenate(x) for x in (names, keys, least, most, lengths))
        data, begin = np.concatenate(texts_of), np.cumsum(size) - size
        order = np.lexsort((name, key))
        at = _bounds(name[order])
        one = order[at]
        low, high = np.minimum.reduceat(low[order], at), np.maximum.reduceat(high[order], at)
        key, size, begin = key[one], size[one], begin[one]
        for share, a, b in _cuts(_shares(key, count)):
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "share": share,
                        "unit": unit,
                        "keys": key[a:b].tobytes(),
                        "sizes": size[a:b].astype(np.uint32).tobytes(),
                        "least": low[a:b].tobytes(),
                        "most": high[a:b].tobytes(),
                        "data": data[ranges(begin[a:b], size[a:b])].tobytes(),
                    }
                ]
            )

    return _each_unit(run)


def _equal_groups(data: np.ndarray, places: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``places`` by their first ``LENGTH`` bytes within each group, and group starts.

    One pass a digit, the most significant first. A suffix that is alone in its group is left where
    it is and not looked at again.
    """
    order = np.argsort(group, kind="stable")
    group = group[order]
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    start = np.zeros(len(order), bool)
    start[_bounds(group)] = True
    for depth in range(0, LENGTH, 8):
        head = np.flatnonzero(start)
        alone = np.diff(np.append(head, len(start))) == 1
        live = np.ones(len(start), bool)
        live[head[alone]] = False
        live = np.flatnonzero(live)
        if not len(live):
            break
        digit = np.ascontiguousarray(eight[places[order[live]] + depth]).view(">u8").ravel().astype(np.uint64)
        if LENGTH - depth < 8:
            digit >>= np.uint64(8 * (8 - (LENGTH - depth)))
        block = np.cumsum(start)[live]
        turn = np.lexsort((digit, block))
        order[live] = order[live][turn]
        digit, block = digit[turn], block[turn]
        start[live[1:][(digit[1:] != digit[:-1]) | (block[1:] != block[:-1])]] = True
    return order, np.flatnonzero(start)


def _least_ids(table: pa.Table) -> pa.Table:
    """For one share: per unit and segment, runs of windows with the smallest id that has them."""

    def joined(column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(table[column].to_pylist()), kind)

    key, size = joined("keys", np.uint64), joined("sizes", np.uint32).astype(np.int64)
    low, high = joined("least", np.int64), joined("most", np.int64)
    counts = [len(k) // 8 for k in table["keys"].to_pylist()]
    unit = np.repeat(np.array(table["unit"].to_pylist(), np.int64), counts)
    if not len(size):
        return _least_of_windows(unit, key, joined("data", np.uint64), low, high)
    data = joined("data", np.uint8)
    begin = np.cumsum(size) - size
    name = mix(key + segment_hashes(prefix_sums(data), begin, begin + size))
    order = np.lexsort((name, key))
    at = _bounds(name[order])
    smallest = np.minimum.reduceat(low[order], at)  # of each distinct segment
    of = np.empty(len(name), np.int64)  # distinct segment of each row
    of[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(order))))
    one = order[at]
    windows = size[one] - LENGTH + 1
    key_at = _bounds(key[one])
    several = np.repeat(np.diff(np.append(key_at, len(one))) > 1, np.diff(np.append(key_at, len(one))))
    # Suffixes of segments that meet others under their key.
    rows = np.flatnonzero(several)
    places = ranges(begin[one[rows]], windows[rows])
    owner = np.repeat(rows, windows[rows])
    ids = smallest[owner]
    if len(places):
        ranks = np.cumsum(np.concatenate(([0], np.diff(key[one[rows]]) != 0)).astype(np.int64))
        turn, heads = _equal_groups(data, places, np.repeat(ranks, windows[rows]))
        ids[turn] = np.repeat(np.minimum.reduceat(ids[turn], heads), np.diff(np.append(heads, len(turn))))
    # Runs of windows with one smallest id.
    new = np.ones(len(places), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (owner[1:] != owner[:-1])
    run = np.flatnonzero(new)
    length = np.diff(np.append(run, len(places)))
    first_of = np.zeros(len(one) + 1, np.int64)
    first_of[rows] = np.cumsum(windows[rows]) - windows[rows]
    settled = np.flatnonzero(~several)
    run_owner = np.concatenate((owner[run], settled))
    run_from = np.concatenate((run - first_of[owner[run]], np.zeros(len(settled), np.int64)))
    run_count = np.concatenate((length, windows[settled]))
    run_id = np.concatenate((ids[run], smallest[settled]))
    turn = np.argsort(run_owner, kind="stable")
    run_owner, run_from, run_count, run_id = run_owner[turn], run_from[turn], run_count[turn], run_id[turn]
    firsts, lasts = np.searchsorted(run_owner, of, "left"), np.searchsorted(run_owner, of, "right")
    pick = ranges(firsts, lasts - firsts)
    asked = np.repeat(np.arange(len(of)), lasts - firsts)
    keep = run_id[pick] < high[asked]
    pick, asked = pick[keep], asked[keep]
    return pa.table(
        {
            "unit": unit[asked],
            "name": name[asked].view(np.int64),
            "begin": run_from[pick].astype(np.int32),
            "windows": run_count[pick].astype(np.int32),
            "least": run_id[pick],
        }
    )


def _least_of_windows(unit: np.ndarray, key: np.ndarray, name: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Table:
    """The same for a share of single windows; equal ones have the same key and name."""
    order = np.lexsort((key, name))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(name[order]) != 0) | (np.diff(key[order]) != 0)
    at = np.flatnonzero(new)
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(low[order], at), np.diff(np.append(at, len(order))))
    keep = least < high
    n = int(keep.sum())
    return pa.table({"unit": unit[keep], "name": name[keep].view(np.int64), "begin": np.zeros(n, np.int32), "windows": np.ones(n, np.int32), "least": least[keep]})


def _cover(asked: str, replies: str):
    def run(unit, batches):
        hot = _answered(asked, unit, "hot")
        table = read_unit(replies, unit)
        if table is not None:
            name = table["name"].to_numpy().view(np.uint64)
            turn = np.argsort(name, kind="stable")
            name = name[turn]
            begin, windows, least = (table[c].to_numpy()[turn].astype(np.int64) for c in ("begin", "windows", "least"))
        for batch in pieces(batches, 1):
            known = np.asarray(batch.column(0).is_valid())
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
            for texts in slices(batch.column(1)):
                n = len(texts.data)
                step = np.zeros(n + 1, np.int64)
                if table is not None and len(name):
                    segments = Segments(texts)
                    segments.split(hot)
                    mine = segments.names()
                    low, high = np.searchsorted(name, mine, "left"), np.searchsorted(name, mine, "right")
                    pick, of = ranges(low, high - low), np.repeat(np.arange(len(mine)), high - low)
                    rows = texts.first + segments.text[of]
                    hit = known[rows] & (least[pick] < ids[rows])
                    start = segments.first[of[hit]] + begin[pick[hit]]
                    np.add.at(step, start, 1)
                    np.add.at(step, start + windows[pick[hit]] + LENGTH - 1, -1)
                gone = np.cumsum(step[:-1]) > 0
                starts = texts.starts
                head = gone.copy()
                head[1:] &= ~gone[:-1]
                head[starts[(starts < n)]] = gone[starts[starts < n]]
                totals, heads = np.concatenate(([0], np.cumsum(gone))), np.concatenate(([0], np.cumsum(head)))
                out["n_bytes"] += (texts.ends - starts).tolist()
                out["n_removed"] += (totals[texts.ends] - totals[starts]).tolist()
                out["n_spans"] += (heads[texts.ends] - heads[starts]).tolist()
                for a, b in zip(starts.tolist(), texts.ends.tolist(), strict=True):
                    part = texts.data[a:b]
                    out["kept_sha256"].append(hashlib.sha256(part[~gone[a:b]].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(v, pa.string() if k == "kept_sha256" else pa.int64()) for k, v in out.items())], ["doc_id", *out])

    return _each_unit(run)


def sent_segments(rows: DataFrame, count: int) -> tuple[DataFrame, str]:
    """What meets in each share of the keys, and of the single windows of hot keys; and the folder of each unit's keys."""
    asked = rows.mapInArrow(_send_keys(count, OFTEN), "share long, unit long, keys binary, shared binary, many binary, windows binary")
    found = asked.groupBy("share").applyInArrow(_repeated_keys(HOT), "unit long, keys binary, hot binary")
    keys = fresh_folder(rows.sparkSession, "repeated-keys")
    found.repartition("unit").write.partitionBy("unit").parquet(keys)
    kind = "share long, unit long, keys binary, sizes binary, least binary, most binary, data binary"
    return rows.mapInArrow(_send_segments(count, keys), kind), keys


def rows_in_units(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id``, ``text``, ``unit`` stored and read again, and the bytes they take."""
    spark = docs.sparkSession
    path = fresh_folder(spark, "rows")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("unit", F.spark_partition_id())
    rows.write.option("compression", "zstd").parquet(path)
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(context._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return spark.read.schema(rows.schema).parquet(path), size


def repeated_substrings(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` for every row of ``docs(doc_id, text)``.

    A byte is removed if a ``LENGTH``-byte string over it also starts in a document with a smaller
    id. Null texts are empty; texts shorter than ``LENGTH`` lose nothing. Rows without an id lose
    nothing and are matched by none; rows that share an id never remove each other's text. Other
    columns are not read. An empty table gives an empty result.

    The result does not depend on the number of cores or executors, nor on its changing between the passes.
    """
    spark = docs.sparkSession
    rows, size = rows_in_units(docs)
    rows = bounded(rows)
    count = max(SHARES * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARE_BYTES))

    sent, keys = sent_segments(rows, count)
    runs = sent.groupBy("share").applyInArrow(_least_ids, "unit long, name long, begin int, windows int, least long")
    covered = fresh_folder(spark, "runs")
    runs.repartition("unit").write.option("compression", "zstd").partitionBy("unit").parquet(covered)
    return rows.mapInArrow(_cover(keys, covered), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
