"""Best-fit packing with large-item matching, planned on counts of lengths.

A piece has one of ``capacity`` lengths, so the plan needs only how many pieces there are of each: at
most ``capacity`` numbers come to the driver, whatever the corpus. Pieces above a third of the capacity
fit at most two to a sequence; the longest takes the longest partner that fits, which is best for
such pieces. Shorter ones, longest first, fill the smallest remaining gap they fit. Equal cases
are planned at once with their multiplicity.

A piece's place follows from its length and its rank among the pieces of that length. Ranks are counted
within each task while texts are tokenised, and shifted by the counts of the tasks before. No task
ever gathers all pieces of a length.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegauge.llm.kernel import pieces as cut_batches
from tidegauge.llm.kernel import slices
from tidegauge.llm.store import bounded, stored
from tidegauge.llm.tokens import encoder_of

CAPACITY = 4096
END_ID = 1


def _tokenised(tokenizer: str, capacity: int, end_id: int):
    def run(batches):
        task = TaskContext.get().partitionId()
        encoder, seen = encoder_of(tokenizer), np.zeros(capacity + 1, np.int64)
        for batch in cut_batches(batches, 1):
            columns: dict[str, list] = {k: [] for k in ("row", "piece", "start", "length", "ids_crc32")}
            for texts in slices(batch.column(1)):
                ids, counts = encoder.encode(texts)
                end = 0
                for row, n in enumerate(counts.tolist(), texts.first):
                    own = np.append(ids[end : end + n], np.uint32(end_id)).astype("<u4")
                    end += n
                    for k, at in enumerate(range(0, n + 1, capacity)):
                        part = own[at : at + capacity]
                        for name, value in zip(columns, (row, k, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                            columns[name].append(value)
            length = np.array(columns["length"], np.int64)
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order], "left")
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - first
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            doc = batch.column(0).cast(pa.int64()).take(pa.array(columns.pop("row"), pa.int64()))
            yield pa.RecordBatch.from_arrays([doc, *(pa.array(v, pa.int64()) for v in columns.values()), pa.array(rank), pa.array(np.full(len(rank), task, np.int64))], ["doc_id", *columns, "rank", "task"])

    return run


class Plan:
    """Sequences of equal make-up: for each length, runs of places that pieces take by rank."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.capacity, self.sequences = capacity, 0
        #: Per length: (number of pieces, first sequence, pieces side by side in each, offset of the first).
        self.runs: dict[int, list[tuple[int, int, int, int]]] = {}
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
        left = {n: c for n, c in counts.items() if c}
        self._match_large({n: c for n, c in left.items() if 3 * n > capacity})
        for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
            self._fill(n, left[n])

    def _open(self, gap: int, first: int, many: int) -> None:
        if many and gap:
            self.gaps.setdefault(gap, []).append((first, many))

    def _place(self, length: int, first: int, many: int, side: int, offset: int) -> None:
        self.runs.setdefault(length, []).append((many * side, first, side, offset))

    def _match_large(self, left: dict[int, int]) -> None:
        """Two to a sequence: the longest left with the longest that fits beside it."""
        for a in sorted(left, reverse=True):
            while left[a]:
                b = max((n for n in left if left[n] and n <= self.capacity - a and (n != a or left[a] > 1)), default=0)
                if not b:
                    self._place(a, self.sequences, left[a], 1, 0)
                    self._open(self.capacity - a, self.sequences, left[a])
                    self.sequences += left[a]
                    left[a] = 0
                    break
                many = left[a] // 2 if a == b else min(left[a], left[b])
                self._place(a, self.sequences, many, 1, 0)
                self._place(b, self.sequences, many, 1, a)
                self._open(self.capacity - a - b, self.sequences, many)
                self.sequences += many
                left[a] -= many
                left[b] -= many

    def _fill(self, length: int, count: int) -> None:
        """Each piece into the smallest gap it fits; what fits nowhere opens sequences."""
        for gap in sorted(g for g in self.gaps if g >= length):
            side = gap // length
            groups = self.gaps.pop(gap)
            while groups and count:
                first, many = groups.pop()
                full = min(many, count // side)
                if full:
                    self._place(length, first, full, side, self.capacity - gap)
                    self._open(gap - side * length, first, full)
                    count -= full * side
                    first, many = first + full, many - full
                if many and 0 < count < side:
                    self._place(length, first, 1, count, self.capacity - gap)
                    self._open(gap - count * length, first, 1)
                    count, first, many = 0, first + 1, many - 1
                if many:
                    groups.append((first, many))
            if groups:
                self.gaps.setdefault(gap, []).extend(groups)
            if not count:
                return
        side = self.capacity // length
        for many, beside in ((count // side, side), (1 if count % side else 0, count % side)):
            if many:
                self._place(length, self.sequences, many, beside, 0)
                self._open(self.capacity - beside * length, self.sequences, many)
                self.sequences += many

    def lookup(self) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Sequence and offset for arrays of lengths and ranks."""
        table = {n: np.array(runs, np.int64) for n, runs in self.runs.items()}

        def find(lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, heads = np.unique(lengths[order], return_index=True)
            for n, rows in zip(values.tolist(), np.split(order, heads[1:]), strict=True) if len(order) else ():
                runs = table[n]
                ends = np.cumsum(runs[:, 0])
                which = np.searchsorted(ends, ranks[rows], "right")
                count, first, side, begin = runs[which].T
                inner = ranks[rows] - (ends[which] - count)
                sequence[rows], offset[rows] = first + inner // side, begin + inner % side * n
            return sequence, offset

        return find


def _placed(plan: Plan):
    find = plan.lookup()

    def run(batches):
        for batch in batches:
            sequence, offset = find(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    return run


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Per piece ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    Every document's ids are followed by ``end_id``, so a null or empty text is one piece of that id.
    Only documents longer than ``capacity`` are cut. Rows without an id or with one that others have
    are documents of their own. Other columns are not read. An empty table gives an empty result.
    """
    rows = bounded(docs.select("doc_id", "text")).mapInArrow(_tokenised(tokenizer, capacity, end_id), "doc_id long, piece long, start long, length long, ids_crc32 long, rank long, task long")
    rows = stored(rows, "pieces")
    by_task = rows.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = stored(by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = rows.join(by_task.select("task", "length", "before"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    kind = "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(Plan(counts, capacity)), kind)
