"""Walk-forward evaluation of a random forest, one model per window whose score is not up to date.

The series is a Parquet table sorted by ``t``: a window's rows come from the few row groups that
its bounds leave. Several windows train side by side, and each group of windows is scored and
stored by one job, so that a run that breaks off continues where it stopped.
"""

from __future__ import annotations

import datetime
from collections import deque
from collections.abc import Sequence
from functools import reduce
from itertools import batched
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Model
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidegauge.constants import BATCH_SIZE, FEATURES, FOREST_SEED, LABEL, NUM_TREES, WINDOW_SIZE
from tidegauge.operators.latest import absent_from, read_parts, read_replacing
from tidegauge.operators.windows import WindowGrid, checked_windows, error_by_window
from tidegauge.plans.models import ModelStore, assembled, fingerprint, predicted
from tidegauge.plans.walk_forward_linear import complete_rows
from tidegauge.schemas import ML_PERFORMANCE
from tidegauge.sinks import stamped, write_part
from tidegauge.sinks.tables import PART

# Tasks that a train set is spread over. The forest depends on it, so it never follows the data:
# raise it where windows hold very many rows.
TRAIN_TASKS = 4
# Equal rows that stay together when a train set is spread.
ROWS_PER_LOT = 10_000
# Windows scored and stored by one job.
WINDOWS_PER_WRITE = 64


def store_series(series: DataFrame, path: str) -> str:
    """Write the series in ranges of ``t``, each file sorted by it.

    The reading task is a second range key: it lets a range end inside a ``t`` that has very many rows.
    """
    salted = series.withColumn("_task", F.spark_partition_id())
    ranges = salted.repartitionByRange("t", "_task").drop("_task")
    ranges.sortWithinPartitions("t").write.mode("overwrite").parquet(path)
    return path


def fixed_layout(df: DataFrame, tasks: int = TRAIN_TASKS) -> DataFrame:
    """The same rows in the same tasks in the same order on every run.

    A forest draws its samples by partition and position, so a seed alone does not fix it. Rows are
    spread by their values; equal rows, which a hash would keep together however many they are, are
    counted and dealt out in lots.
    """
    order = ["t", *[c for c in df.columns if c != "t"]]
    lots = (
        df.groupBy(*order)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_lot", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {ROWS_PER_LOT})")))
    )
    in_lot = F.expr(f"least({ROWS_PER_LOT}L, _copies - _lot * {ROWS_PER_LOT})").cast("int")
    return (
        lots.repartition(tasks, *order, "_lot")
        .select(*order, F.explode(F.array_repeat(F.lit(0), in_lot)).alias("_copy"))
        .drop("_copy")
        .sortWithinPartitions(*order)
    )


# A score is up to date as long as these of its window are what they were.
CHECKED = ("t_end", "n_train", "n_test", "train_sum", "test_sum")


def pending_windows(rows: DataFrame, grid: WindowGrid, stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Valid windows that have no score, or one made from other rows than there are now, oldest first.

    A half-filled test part, rows that arrive late and corrected values all lead to a new score, which
    replaces the one before.
    """
    return absent_from(checked_windows(rows, grid, columns), stored, CHECKED).orderBy("t_end")


def read_series(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame | None:
    """The stored series, or None where nothing has been stored yet."""
    try:
        return spark.read.parquet(path).select("t", *columns)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def grid_of(series: DataFrame, stored: DataFrame, window_size: int, batch_size: int, restart: bool) -> WindowGrid:
    """Ends counted from the origin of the scores stored last, or anew from ``min(t)``."""
    last = None if restart else stored.agg(F.max_by("origin", PART)).first()[0]
    return WindowGrid(series, window_size, batch_size, origin=last)


def default_forest(num_trees: int = NUM_TREES, seed: int = FOREST_SEED) -> RandomForestRegressor:
    return RandomForestRegressor(numTrees=num_trees, seed=seed)


def prepared(forest: RandomForestRegressor, label: str) -> RandomForestRegressor:
    return forest.copy({forest.featuresCol: "features", forest.labelCol: label})


def kept_models(
    spark: SparkSession,
    models: str,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    forest: RandomForestRegressor | None = None,
    tasks: int = TRAIN_TASKS,
) -> ModelStore:
    """The models that `evaluate_forest` keeps in a folder, when it is called with the same arguments."""
    return ModelStore(spark, models, fingerprint(prepared(forest or default_forest(), label), features, label, tasks))


class ForestEvaluation:
    """Fits and scores single windows of one stored series."""

    def __init__(
        self,
        rows: DataFrame,
        features: Sequence[str],
        label: str,
        window_size: int,
        batch_size: int,
        forest: RandomForestRegressor,
        tasks: int,
        models: str | None = None,
    ):
        self.rows = rows
        self.features = list(features)
        self.label = label
        self.window_size = window_size
        self.batch_size = batch_size
        self.forest = prepared(forest, label)
        self.tasks = tasks
        self.models = None if models is None else kept_models(rows.sparkSession, models, features, label, forest, tasks)
        self.new: deque[tuple[Row, str]] = deque()

    def with_models(self, windows: DataFrame) -> DataFrame:
        """The windows with the path of a kept model for the same train rows, if there is one."""
        if self.models is None:
            return windows
        return windows.join(self.models.index(), ["t_end", "n_train", "train_sum"], "left").orderBy("t_end")

    def between(self, low: int, high: int) -> DataFrame:
        return self.rows.filter(f"t >= {low} AND t < {high}")

    def fitted(self, window: Row) -> Model:
        """The window's forest, from the store where it has one for the same train rows."""
        if self.models is not None and window["model"] is not None:
            return self.models.load(window["model"])
        end = window["t_end"]
        model = self.forest.fit(assembled(fixed_layout(self.between(end - self.window_size, end), self.tasks), self.features))
        if self.models is not None:
            self.new.append((window, self.models.save(model, window)))
        return model

    def scored(self, window: Row) -> DataFrame:
        """The window's test rows with their prediction, not yet computed."""
        end = window["t_end"]
        test = self.between(end, end + self.batch_size)
        scored = predicted(self.fitted(window), test, self.features)
        return scored.select(
            *(F.lit(window[c]).cast("bigint").alias(c) for c in CHECKED), F.lit(window["complete"]).alias("complete"), self.label, "prediction"
        )

    def keep_new(self) -> None:
        """Put the models fitted since the last time into the index."""
        if self.models is not None:
            self.models.add([self.new.popleft() for _ in range(len(self.new))])


SCORED = (*CHECKED, "complete")


def evaluate_forest(
    spark: SparkSession,
    series_path: str,
    metrics_path: str,
    *,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    window_size: int = WINDOW_SIZE,
    batch_size: int = BATCH_SIZE,
    num_trees: int = NUM_TREES,
    seed: int = FOREST_SEED,
    forest: RandomForestRegressor | None = None,
    tasks: int = TRAIN_TASKS,
    parallelism: int | None = None,
    restart_grid: bool = False,
    processed_at: Column | datetime.datetime | None = None,
    models: str | None = None,
) -> DataFrame:
    """Score every window whose score is not up to date, store the scores, return all of them.

    With ``models``, the folder of a `ModelStore`, fitted forests are kept there, and a window whose train rows
    are those of a kept forest is scored by that one.

    ``forest`` replaces the default one of ``num_trees`` and ``seed``. Only window ends and counts come
    to the driver, a partition at a time. As many windows train side by side as there are cores, and
    training goes on while a group of scores is stored. Without a stored series nothing happens.
    """
    columns = [*features, label]
    series = read_series(spark, series_path, columns)
    if series is None:
        return stored_metrics(spark, metrics_path)
    rows = complete_rows(series, columns)
    forest = forest or default_forest(num_trees, seed)
    evaluation = ForestEvaluation(rows, features, label, window_size, batch_size, forest, tasks, models)

    grid = grid_of(series, read_parts(spark, metrics_path, ML_PERFORMANCE), window_size, batch_size, restart_grid)
    pending = evaluation.with_models(pending_windows(rows, grid, stored_metrics(spark, metrics_path), columns))

    with ThreadPool(parallelism or spark.sparkContext.defaultParallelism) as pool:
        scored = pool.imap(inheritable_thread_target(spark)(evaluation.scored), pending.toLocalIterator())
        for number, group in enumerate(batched(scored, WINDOWS_PER_WRITE), next_part(spark, metrics_path)):
            metrics = error_by_window(reduce(DataFrame.unionByName, group), label, SCORED)
            metrics = metrics.withColumn("origin", F.lit(grid.first_t).cast("bigint"))
            write_part(stamped(metrics, processed_at), metrics_path, number, ["t_end"])
            evaluation.keep_new()
    return stored_metrics(spark, metrics_path)


def next_part(spark: SparkSession, metrics_path: str) -> int:
    last = read_parts(spark, metrics_path, ML_PERFORMANCE).agg(F.max(PART)).first()[0]
    return 0 if last is None else last + 1


def stored_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """One row per ``t_end``, the last one stored."""
    return read_replacing(spark, metrics_path, ML_PERFORMANCE, ["t_end"])
