"""Sliding train and tumbling test windows over integer time.

Window ``j`` ends at ``t_end = origin + window_size + j * batch_size``, where the origin is ``min(t)``
unless an earlier evaluation fixed it: rows that are purged or arrive late do not move the ends.
Rows before the origin are in no window. A window trains on
``[t_end - window_size, t_end)`` and tests on ``[t_end, t_end + batch_size)``. Ends are smaller
than ``max(t)``: with ``(max(t) - origin - window_size)`` a multiple of ``batch_size`` the row at
``max(t)`` is in no test part. A window is valid when both of its parts have rows.

Ends and window edges all fall on multiples of the greatest common divisor of the two sizes,
counted from the origin. So the rows are first reduced to one aggregate per *block* of that
length, and only the block aggregates are copied into the windows they belong to. The rows
themselves are shuffled as partial sums and never replicated.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.constants import BATCH_SIZE, WINDOW_SIZE
from tidegauge.functions import floor_div
from tidegauge.operators.intervals import interval_join


class WindowGrid:
    """Column arithmetic between time, blocks and windows for one series."""

    def __init__(
        self, series: DataFrame, window_size: int = WINDOW_SIZE, batch_size: int = BATCH_SIZE, origin: int | None = None
    ):
        self.window_size = window_size
        self.batch_size = batch_size
        self.block_size = gcd(window_size, batch_size)
        self.train_blocks = window_size // self.block_size
        self.step_blocks = batch_size // self.block_size
        # Two numbers, and the only thing computed ahead. As literals they fold into the bounds
        # that reach the scan; as subqueries they would not.
        self.first_t, self.last_t = series.agg(F.min("t"), F.max("t")).first()
        if self.first_t is None:
            self.first_t = self.last_t = 0
        if origin is not None:
            self.first_t = origin

    def block(self, t: str = "t") -> Column:
        return floor_div(F.col(t) - self.first_t, self.block_size)

    def end(self, window: Column) -> Column:
        return window * self.batch_size + (self.first_t + self.window_size)

    def tested_at(self, t: str = "t") -> Column:
        """End of the window that tests this time, if one does."""
        return self.end(floor_div(F.col(t) - (self.first_t + self.window_size), self.batch_size))

    def is_tested(self, t: str = "t") -> Column:
        """The time belongs to the test part of a window: neither before the first nor past the last."""
        first_end = self.first_t + self.window_size
        n_ends = len(range(first_end, self.last_t, self.batch_size))
        return (F.col(t) >= first_end) & (F.col(t) < first_end + n_ends * self.batch_size)

    def is_open(self, t_end: Column) -> Column:
        """The end lies before the last row's time."""
        return t_end < self.last_t

    def is_complete(self, t_end: Column) -> Column:
        """The series has reached the end of the test part."""
        return t_end + self.batch_size <= self.last_t + 1

    def memberships(self, block: str = "block") -> Column:
        """All ``(window, is_train)`` pairs of a block, at most ``train_blocks + 1`` of them."""
        b = F.col(block)
        first = F.greatest(floor_div(b - (self.train_blocks - self.step_blocks), self.step_blocks), F.lit(0).cast("bigint"))
        last = floor_div(b, self.step_blocks)
        # ``sequence`` counts downwards when its bounds are reversed.
        training = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        test = floor_div(b - self.train_blocks, self.step_blocks)
        testing = F.when(test >= 0, F.array(test)).otherwise(F.array().cast("array<bigint>"))

        def marked(windows: Column, is_train: bool) -> Column:
            return F.transform(windows, lambda j: F.struct(j.alias("window"), F.lit(is_train).alias("is_train")))

        return F.inline(F.concat(marked(training, True), marked(testing, False)))

    def place(self, blocks: DataFrame) -> DataFrame:
        """Block aggregates copied into their windows: adds ``t_end`` and ``is_train``."""
        placed = blocks.select(self.memberships(), *blocks.columns)
        t_end = self.end(F.col("window"))
        return placed.filter(self.is_open(t_end)).select(t_end.alias("t_end"), "is_train", *blocks.columns)


def window_membership(rows: DataFrame, grid: WindowGrid | None = None) -> DataFrame:
    """``t_end``, ``n_train``, ``n_test`` and ``complete`` of every valid window.

    ``grid`` belongs to the whole series when ``rows`` are only its usable part.
    """
    grid = grid or WindowGrid(rows)
    blocks = rows.groupBy(grid.block().alias("block")).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return (
        grid.place(blocks)
        .groupBy("t_end")
        .agg(
            F.sum(F.when(F.col("is_train"), F.col("n")).otherwise(zero)).alias("n_train"),
            F.sum(F.when(~F.col("is_train"), F.col("n")).otherwise(zero)).alias("n_test"),
        )
        .filter("n_train > 0 AND n_test > 0")
        .withColumn("complete", grid.is_complete(F.col("t_end")))
    )


# Halves of a row's hash, which are summed apart: half a hash for each of 2**31 rows fits a BIGINT.
_HALF = 32


def checked_windows(rows: DataFrame, grid: WindowGrid, columns: Sequence[str]) -> DataFrame:
    """`window_membership` with ``train_sum`` and ``test_sum``: checksums of the given columns in each part.

    A sum of hashes does not depend on the order of the rows, counts equal ones each, and changes with any value. Like
    the counts it is made per block and merged by window.
    """
    hashed = F.xxhash64("t", *columns)
    halves = {"upper": F.shiftrightunsigned(hashed, _HALF), "lower": hashed.bitwiseAND(F.lit((1 << _HALF) - 1))}
    sums = [F.sum(half).alias(name) for name, half in halves.items()]
    blocks = rows.groupBy(grid.block().alias("block")).agg(F.count(F.lit(1)).alias("n"), *sums)
    placed = grid.place(blocks).groupBy("t_end")
    zero = F.lit(0).cast("bigint")

    def total(column: str, of_train: bool) -> Column:
        return F.sum(F.when(F.col("is_train") == of_train, F.col(column)).otherwise(zero))

    found = placed.agg(
        *(total(column, of_train).alias(f"{part}_{column}") for part, of_train in (("train", True), ("test", False)) for column in ("n", *halves))
    )
    return found.filter("train_n > 0 AND test_n > 0").select(
        "t_end",
        F.col("train_n").alias("n_train"),
        F.col("test_n").alias("n_test"),
        *(F.xxhash64(f"{part}_upper", f"{part}_lower").alias(f"{part}_sum") for part in ("train", "test")),
        grid.is_complete(F.col("t_end")).alias("complete"),
    )


def window_rows_at(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """``t_end``, ``is_train`` and the columns of ``rows`` for windows ``ends(t_end, train_from, test_until)`` of any spacing and length."""
    placed = interval_join(rows, ends.select("t_end", "train_from", "test_until"), "t", "train_from", "test_until")
    return placed.select("t_end", (F.col("t") < F.col("t_end")).alias("is_train"), *rows.columns)


def error_by_window(scored: DataFrame, label: str = "y", keys: Sequence[str] = ("t_end",)) -> DataFrame:
    """Mean absolute error and mean prediction per ``t_end``."""
    return scored.groupBy(*keys).agg(
        F.avg(F.abs(F.col(label) - F.col("prediction"))).alias("mae"),
        F.avg("prediction").alias("mean_pred"),
    )
