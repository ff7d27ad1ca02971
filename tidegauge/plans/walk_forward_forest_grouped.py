"""Walk-forward evaluation of random forests, all windows in a fixed number of jobs.

One library fit per window costs a dozen small jobs, whatever the window holds; a backfill over
very many windows then only waits for the driver. Here the trees of all windows grow together, one
level per job: a level is a grouped sum over (window, tree, node, feature, bin), a choice of the best
cut per node, and an equi-join that sends the drawn rows to their next node.

Drawn rows are partitioned by tree once and kept so; a level shuffles sums and cuts. A task meets the
rows of a tree one after the other, so a window with very many of them takes time, not memory.

The forest is the usual one for regression: rows drawn with replacement (Poisson weights), a third
of the features per node, cuts at 1/32 quantiles of the window, greatest reduction of variance,
the mean as leaf. Draws are hashes of (seed, window, tree, time, rank among the rows of that time), and
targets are summed as whole steps of the window's own range, so the result is the same on any number
of tasks and for targets of any size.
"""

from __future__ import annotations

import datetime
import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegauge.constants import (
    BATCH_SIZE,
    FEATURES,
    FOREST_SEED,
    LABEL,
    MAX_BINS,
    MAX_DEPTH,
    NUM_TREES,
    WINDOW_SIZE,
)
from tidegauge.operators.latest import read_parts
from tidegauge.operators.windows import WindowGrid, error_by_window
from tidegauge.plans.walk_forward_forest import SCORED, grid_of, next_part, pending_windows, read_series, stored_metrics
from tidegauge.plans.walk_forward_linear import complete_rows, numbered
from tidegauge.schemas import ML_PERFORMANCE
from tidegauge.scratch import fresh_folder
from tidegauge.sinks import stamped, write_part, write_snapshot

# Targets are summed as multiples of this fraction of the range they have in their window.
TARGET_STEPS = 2**31
# Equal rows that are numbered together.
ROWS_PER_LOT = 10_000

TREE = ("t_end", "tree")
NODE = (*TREE, "node")


def poisson_steps() -> list[float]:
    """Distribution function of Poisson(1), as far as 32 random bits tell its values apart."""
    steps, term = [math.exp(-1)], math.exp(-1)
    while steps[-1] < 1 - 2**-32:
        term /= len(steps)
        steps.append(steps[-1] + term)
    return steps


def ranked_rows(rows: DataFrame) -> DataFrame:
    """Add ``nth``, each row's number among the rows of its time, by value: equal rows get neighbouring numbers.

    Equal rows are counted first. The distinct ones are sorted by range over all tasks, and a task's
    numbers for a time start where those of the tasks before it end, so no task sorts a whole time.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = counted.repartitionByRange(*columns).withColumn("_task", F.spark_partition_id())
    spark = rows.sparkSession
    ranged = spark.read.parquet(write_snapshot(ranged, fresh_folder(spark, "ranked")))
    by_task = ranged.groupBy("t", "_task").agg(F.sum("_copies").alias("_size"))
    earlier = Window.partitionBy("t").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.select("t", "_task", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy("t", "_task").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_before", F.coalesce(F.sum("_copies").over(within), F.lit(0))).join(by_task, ["t", "_task"])
    lots = placed.withColumn("_lot", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {ROWS_PER_LOT})")))
    in_lot = f"sequence(_lot * {ROWS_PER_LOT}, least((_lot + 1) * {ROWS_PER_LOT}, _copies) - 1)"
    numbered_rows = lots.withColumn("_copy", F.explode(F.expr(in_lot)))
    return numbered_rows.select(*columns, F.expr("_base + _before + _copy").alias("nth"))


def _binned(
    series: DataFrame, grid: WindowGrid, features: Sequence[str], label: str, only: DataFrame | None
) -> DataFrame:
    """Train and test rows of every window, each feature as the number of its window's cut."""
    p = len(features)
    values = [f"v{i}" for i in range(p)]
    rows = ranked_rows(numbered(series, [*features, label])).withColumn("block", grid.block())
    placed = grid.place(rows).select("t_end", "is_train", "t", "nth", *values, F.col(f"v{p}").alias("y"))
    if only is not None:
        placed = placed.join(only.select("t_end"), "t_end", "left_semi")
    quantiles = F.array(*[F.lit(k / MAX_BINS) for k in range(1, MAX_BINS)])
    cuts = (
        placed.filter("is_train")
        .groupBy("t_end")
        .agg(
            F.avg("y").alias("train_mean"),
            F.min("y").alias("low"),
            F.max("y").alias("high"),
            *[F.percentile_approx(v, quantiles, 10_000).alias(f"cuts_{v}") for v in values],
        )
    )
    bins = ", ".join(f"size(filter(cuts_{v}, c -> c < {v}))" for v in values)
    step = f"(high - low) / {TARGET_STEPS} AS step"
    return placed.join(cuts, "t_end").selectExpr("t_end", "is_train", "t", "nth", f"array({bins}) AS bins", "y", "train_mean", "low", step)


def _drawn(binned: DataFrame, num_trees: int, seed: int) -> DataFrame:
    """Train rows once per tree that draws them: ``w`` times, with ``s`` as their summed target."""
    bits = f"conv(substr(md5(concat_ws(':', {seed}, t_end, tree, t, nth)), 1, 8), 16, 10)"
    # As the output of a generator ``u`` is computed once; a filter on a projected column would
    # be moved below it and repeat the hash for every comparison.
    draws = f"inline(transform(sequence(0, {num_trees - 1}), tree -> struct(tree, {bits} / 4294967296D AS u)))"
    weight = " + ".join(f"CAST(u >= {step!r}D AS BIGINT)" for step in poisson_steps())
    return (
        binned.filter("is_train")
        .selectExpr("t_end", "bins", "low", "step", "CAST(if(step > 0, rint((y - low) / step), 0D) AS BIGINT) AS units", f"{draws} AS (tree, u)")
        .selectExpr(*TREE, "bins", "low", "step", "units", f"{weight} AS w")
        .filter("w > 0")
        .selectExpr(*TREE, "bins", "low", "step", "w", "w * units AS s")
    )


def _node_after(levels: int, splits: str) -> str:
    """Node that a row's bins reach after so many levels; a node without split keeps its rows."""
    split = f"get({splits}, node - 1)"
    child = f"2 * node + if(bins[{split}.feature] <= {split}.bin, 0, 1)"
    return f"aggregate(sequence(1, {levels}), 1, (node, level) -> if({split} IS NULL, node, {child}))"


def _best_splits(rows: DataFrame, level: int, seed: int, tried: int) -> DataFrame:
    """``feature`` and ``bin`` of the best cut of each node, where one reduces the variance."""
    # Rows that stopped at a leaf have a smaller node number and add nothing.
    growing = F.expr(f"posexplode(if(node >= {2**level}, bins, CAST(array() AS ARRAY<INT>))) AS (feature, bin)")
    sums = (
        rows.select(*NODE, "w", "s", growing)
        .groupBy(*NODE, "feature", "bin")
        .agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    )
    of_feature = Window.partitionBy(*NODE, "feature")
    up_to_bin = of_feature.orderBy("bin")
    cumulated = sums.select(
        *NODE,
        "feature",
        "bin",
        F.sum("w").over(up_to_bin).alias("lw"),
        F.sum("s").over(up_to_bin).cast("double").alias("ls"),
        F.sum("w").over(of_feature).alias("tw"),
        F.sum("s").over(of_feature).cast("double").alias("ts"),
    )
    gain = "if(lw < tw, ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw) - ts * ts / tw, 0D)"
    by_feature = (
        cumulated.selectExpr(*NODE, "feature", "-bin AS bin", f"{gain} AS gain")
        .groupBy(*NODE, "feature")
        .agg(F.max(F.struct("gain", "bin")).alias("cut"))
    )
    draw = f"md5(concat_ws(':', {seed}, t_end, tree, node, feature))"
    candidates = by_feature.selectExpr(
        *NODE, f"struct({draw} AS draw, struct(cut.gain AS gain, -feature AS feature, cut.bin AS bin) AS cut) AS candidate"
    )
    best = f"array_max(slice(array_sort(collect_list(candidate)), 1, {tried}).cut) AS best"
    return (
        candidates.groupBy(*NODE)
        .agg(F.expr(best))
        .filter("best.gain > 0")
        .selectExpr(*NODE, "-best.feature AS feature", "-best.bin AS bin")
    )


def _trees(splits: DataFrame, levels: int) -> DataFrame:
    """One row per tree: its splits as an array over node numbers, null where a node has none."""
    entry = F.struct("node", F.struct("feature", "bin"))
    by_node = splits.groupBy(*TREE).agg(F.map_from_entries(F.collect_list(entry)).alias("by_node"))
    nodes = f"sequence(1, {2**levels - 1})"
    return by_node.selectExpr(*TREE, f"transform({nodes}, node -> try_element_at(by_node, node)) AS splits")


def _models(drawn: DataFrame, trees: DataFrame, depth: int) -> DataFrame:
    """The trees of each window, in order, with their splits and the mean target of each leaf."""
    leaves = (
        drawn.join(trees, list(TREE), "left")
        .selectExpr(*TREE, f"{_node_after(depth, 'splits')} AS node", "w", "s", "low", "step")
        .groupBy(*NODE)
        .agg(F.expr("first(low) + CAST(sum(s) AS DOUBLE) / sum(w) * first(step) AS mean"))
        .groupBy(*TREE)
        .agg(F.map_from_entries(F.collect_list(F.struct("node", "mean"))).alias("leaves"))
    )
    in_order = "array_sort(collect_list(struct(tree, splits, leaves)), (a, b) -> a.tree - b.tree) AS trees"
    return leaves.join(trees, list(TREE), "left").groupBy("t_end").agg(F.expr(in_order))


def walk_forward_forest_grouped(
    series: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    window_size: int = WINDOW_SIZE,
    batch_size: int = BATCH_SIZE,
    num_trees: int = NUM_TREES,
    depth: int = MAX_DEPTH,
    seed: int = FOREST_SEED,
    only: DataFrame | None = None,
    grid: WindowGrid | None = None,
) -> DataFrame:
    """``t_end``, ``mae`` and ``mean_pred`` of every valid window, or of those in ``only``.

    Incomplete rows take no part. Rows, draws and each level's splits are written to the shared
    folder: later levels read them, and a lost executor costs the level it worked on.
    """
    spark = series.sparkSession
    grid = grid or WindowGrid(series, window_size, batch_size)
    folder = fresh_folder(spark, "forests")
    tried = math.ceil(len(features) / 3)

    binned = spark.read.parquet(write_snapshot(_binned(series, grid, features, label, only), f"{folder}/rows"))
    drawn = spark.read.parquet(write_snapshot(_drawn(binned, num_trees, seed), f"{folder}/drawn"))
    # Kept on disk by tree, so that levels shuffle no rows; what is lost is read again from the folder.
    drawn = drawn.repartition(*TREE).persist(StorageLevel.DISK_ONLY)
    at_level = drawn.withColumn("node", F.lit(1))
    for level in range(depth):
        write_part(_best_splits(at_level, level, seed, tried), f"{folder}/splits", level)
        trees = _trees(spark.read.parquet(f"{folder}/splits"), level + 1)
        routed = drawn.join(trees, list(TREE))
        at_level = routed.selectExpr(*TREE, "w", "s", "bins", f"{_node_after(level + 1, 'splits')} AS node")

    leaf = f"try_element_at(m.leaves, {_node_after(depth, 'm.splits')})"
    forest = f"aggregate(trees, 0D, (total, m) -> total + {leaf}) / size(trees)"
    tests = binned.filter("NOT is_train").select("t_end", "bins", "y", "train_mean")
    # Of a window with a row or two, it can happen that no tree draws any; the mean is left then.
    scored = tests.join(_models(drawn, trees, depth), "t_end", "left")
    return error_by_window(scored.selectExpr("t_end", "y", f"coalesce({forest}, train_mean) AS prediction"))


def evaluate_forest_grouped(
    spark: SparkSession,
    series_path: str,
    metrics_path: str,
    *,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    window_size: int = WINDOW_SIZE,
    batch_size: int = BATCH_SIZE,
    restart_grid: bool = False,
    processed_at: Column | datetime.datetime | None = None,
) -> DataFrame:
    """Score every window whose score is not up to date, store the scores as one part, return all."""
    series = read_series(spark, series_path, [*features, label])
    if series is None:
        return stored_metrics(spark, metrics_path)
    grid = grid_of(series, read_parts(spark, metrics_path, ML_PERFORMANCE), window_size, batch_size, restart_grid)
    pending = pending_windows(complete_rows(series, [*features, label]), grid, stored_metrics(spark, metrics_path), [*features, label])
    if not pending.isEmpty():
        metrics = walk_forward_forest_grouped(series, features, label, window_size, batch_size, only=pending, grid=grid)
        metrics = metrics.join(pending.select(*SCORED), "t_end").withColumn("origin", F.lit(grid.first_t).cast("bigint"))
        write_part(stamped(metrics, processed_at), metrics_path, next_part(spark, metrics_path), ["t_end"])
    return stored_metrics(spark, metrics_path)
