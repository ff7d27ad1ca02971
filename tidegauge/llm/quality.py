"""Quality classifier: ridge regression on random Fourier features, calibrated by isotonic regression.

Documents become a few statistics of their whole text. Random Fourier features of these approximate
a Gaussian kernel. Every partition of labelled rows sums its part of the normal equations, and the
parts are added level by level in Spark; the driver solves systems whose size is the number of
features. Calibration uses scores of rows by the model that did not see them: rows fall into two
folds, each scored by the other's solution. Their histogram of scores, again summed by partition,
goes through pool-adjacent-violators. All labelled rows take part; no sample is drawn.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.kernel import pieces
from tidegauge.llm.statistics import NAMES, statistics
from tidegauge.llm.store import bounded, stored

FEATURES = 256
#: Width of the Gaussian kernel in units of standardised statistics.
WIDTH = 8.0
RIDGE = 3e-3
#: Standardised statistics are held within this range.
REACH = 4.0
BINS = 400
#: A document is predicted good from this score on.
THRESHOLD = 0.3
FOLDS = 5
#: Parts that are added in one task.
FAN_IN = 16

_SHIFTS = np.random.Generator(np.random.PCG64(71))
_DIRECTIONS = _SHIFTS.normal(0, 1 / WIDTH, (len(NAMES), FEATURES))
_PHASES = _SHIFTS.uniform(0, 2 * np.pi, FEATURES)


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and its statistics as an array, stored."""

    def run(batches):
        for batch in pieces(batches, 1):
            values = statistics(batch.column(1)).astype(np.float32)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), len(NAMES)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), rows], ["doc_id", "statistics"])

    return stored(bounded(docs.select("doc_id", "text")).mapInArrow(run, "doc_id long, statistics array<float>"), "statistics")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(-1, len(NAMES))


def summed(rows: DataFrame, of_batch, size: int) -> np.ndarray:
    """Sum of ``of_batch(batch)``, arrays of ``size`` numbers, over all batches of the frame."""

    def first(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def again(batches):
        total = np.zeros(size)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = stored(rows.mapInArrow(first, "part binary"), "sums")
    count = parts.count()
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        parts = stored(parts.repartition(count).mapInArrow(again, "part binary"), "sums")
    total = np.zeros(size)
    for row in parts.collect():
        total += np.frombuffer(row["part"])
    return total


class Model:
    """Everything a score needs: scales, weights, and the calibrated value of each score bin."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        self.mean, self.scale = mean, scale
        self.weights = np.zeros(FEATURES + 1)
        self.values = np.linspace(0, 1, BINS)

    def features(self, statistics: np.ndarray) -> np.ndarray:
        x = np.clip((statistics - self.mean) / self.scale, -REACH, REACH)
        return np.concatenate((np.sqrt(2 / FEATURES) * np.cos(x @ _DIRECTIONS + _PHASES), np.ones((len(x), 1))), axis=1)

    def score(self, raw: np.ndarray) -> np.ndarray:
        """Calibrated scores, linear between the centres of bins."""
        centres = (np.arange(BINS) + 0.5) / BINS * 2 - 0.5
        return np.clip(np.interp(raw, centres, self.values), 0, 1)


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit to the means ``total/weight`` of bins in order; empty bins are filled between."""
    blocks: list[list[float]] = []
    used = np.flatnonzero(weight > 0)
    for i in used:
        blocks.append([total[i], weight[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t, w, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + w, blocks[-1][2] + n]
    if not blocks:
        return np.full(len(weight), 0.5)
    fitted = np.concatenate([np.full(int(n), t / w) for t, w, n in blocks])
    return np.interp(np.arange(len(weight)), used, fitted)


def fitted(rows: DataFrame) -> Model:
    """The model of labelled rows ``statistics``, ``label``, ``fold`` (0 or 1)."""
    k, d = len(NAMES), FEATURES + 1

    def moments(batch) -> np.ndarray:
        x = _matrix(batch.column("statistics"))
        return np.concatenate(([len(x)], x.sum(0), (x**2).sum(0)))

    sums = summed(rows.select("statistics"), moments, 2 * k + 1)
    n = max(sums[0], 1)
    mean = sums[1 : k + 1] / n
    scale = np.sqrt(np.maximum(sums[k + 1 :] / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1))

    def equations(batch) -> np.ndarray:
        z, y, fold = model.features(_matrix(batch.column("statistics"))), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
        parts = [np.concatenate(((z[f].T @ z[f]).ravel(), z[f].T @ y[f], [f.sum()])) for f in (fold == 0, fold == 1)]
        return np.concatenate(parts)

    def solve(part: np.ndarray) -> np.ndarray:
        a, b, m = part[: d * d].reshape(d, d), part[d * d : -1], part[-1]
        return np.linalg.solve(a + RIDGE * max(m, 1) / FEATURES * np.eye(d), b)

    zero, one = summed(rows, equations, 2 * (d * d + d + 1)).reshape(2, -1)
    other = np.stack((solve(one), solve(zero)))  # by the fold that is scored
    model.weights = solve(zero + one)

    def histogram(batch) -> np.ndarray:
        z, y, fold = model.features(_matrix(batch.column("statistics"))), batch.column("label").to_numpy(), batch.column("fold").to_numpy()
        at = bin_of((z * other[fold]).sum(1))
        return np.concatenate((np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)))

    weight, total = summed(rows, histogram, 2 * BINS).reshape(2, -1)
    model.values = isotonic(weight, total)
    return model


def _fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def _learnt(known: DataFrame, labels: DataFrame) -> Model:
    """The model of all labelled rows outside the held-out fold, from their stored statistics."""
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("label"))
    rows = known.where(_fold() % FOLDS != 0).join(marks, "doc_id").select("statistics", "label", (F.floor(_fold() / FOLDS) % 2).cast("int").alias("fold"))
    return fitted(stored(rows, "labelled"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row of ``docs(doc_id, text)``.

    Learns from ``labels(doc_id, quality)`` of rows whose ``crc32(doc_id)`` modulo ``FOLDS`` is not 0; only
    the text is an input of a score. Null and empty texts have zero statistics and are scored as such.
    Rows without an id are scored, never learnt from, and not held out. A document with several labels
    has their mean; null labels are ignored. Without any label all scores are 0.5. Rows that repeat
    are scored each. Other columns are not read. An empty table gives an empty result.
    """
    known = document_statistics(docs)
    model = _learnt(known, labels)

    def run(batches):
        for batch in batches:
            score = model.score(model.features(_matrix(batch.column("statistics"))) @ model.weights)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"]
            )

    marked = known.withColumn("held_out", F.coalesce(_fold() % FOLDS == 0, F.lit(False)))
    return marked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score at least ``THRESHOLD``, with all their columns.

    Learns as `quality_scores` does. The texts are read a second time and judged where they are, so
    that they need no shuffle and rows without an id or with a repeated one are judged each.
    """
    model = _learnt(document_statistics(docs), labels)
    place = docs.columns.index("text")

    def run(batches):
        for batch in pieces(batches, place):
            score = model.score(model.features(statistics(batch.column(place)).astype(np.float32)) @ model.weights)
            yield batch.filter(pa.array(score >= THRESHOLD))

    return bounded(docs).mapInArrow(run, docs.schema)
