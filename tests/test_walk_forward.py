from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from tidegauge.constants import FEATURES
from tidegauge.operators.windows import WindowGrid, window_membership
from tidegauge.plans.walk_forward_forest import evaluate_forest, fixed_layout, store_series, stored_metrics
from tidegauge.plans.walk_forward_forest_grouped import evaluate_forest_grouped, ranked_rows, walk_forward_forest_grouped
from tidegauge.plans.walk_forward_linear import walk_forward_linear
from tidegauge.schemas import ML_PERFORMANCE
from tidegauge.sinks import write_part

SERIES = "t BIGINT, requests BIGINT, size DOUBLE, hour INT, y_lag1 DOUBLE, y DOUBLE"


def series(spark, times, missing=()):
    rows, last = [], 0.0
    for t in times:
        noise = random.Random(t)
        requests, size, hour = noise.randint(30, 70), noise.gauss(100, 10), (t // 60) % 24
        y = 0.5 * last + 0.02 * requests**1.2 + 0.15 * size + noise.gauss(0, 5)
        rows.append((t, requests, size, hour, last, None if t in missing else y))
        last = y
    return spark.createDataFrame(rows, SERIES)


def expected_windows(times, window, batch):
    times = sorted(times)
    found = {}
    for end in range(times[0] + window, times[-1], batch):
        train = sum(end - window <= t < end for t in times)
        test = sum(end <= t < end + batch for t in times)
        if train and test:
            found[end] = (train, test, end + batch <= times[-1] + 1)
    return found


@pytest.mark.parametrize("window,batch", [(100, 20), (30, 20), (7, 3), (5, 10), (12, 12)])
@pytest.mark.parametrize(
    "times",
    [
        range(121),
        range(-130, 50),
        [*range(120), *range(300, 341)],
        [5],
        [t for t in range(400) if t % 3 or t < 150],
        [1, 1, 1, *range(200), 150, 150],
    ],
)
def test_windows_are_those_of_the_plain_loop(spark, times, window, batch):
    df = spark.createDataFrame([(t,) for t in times], "t BIGINT")
    got = window_membership(df, WindowGrid(df, window, batch))
    assert {r["t_end"]: (r["n_train"], r["n_test"], r["complete"]) for r in got.collect()} == expected_windows(
        times, window, batch
    )


def test_last_end_is_exclusive(spark):
    df = spark.range(121).toDF("t")
    grid = WindowGrid(df)
    assert [r["t_end"] for r in window_membership(df, grid).collect()] == [100]
    assert df.filter(grid.is_tested()).agg({"t": "max"}).first()[0] == 119


def test_nothing_in_nothing_out(spark):
    empty = series(spark, [])
    assert window_membership(empty).count() == 0
    assert walk_forward_linear(empty).count() == 0


def test_rows_are_not_replicated(spark):
    """Only block aggregates are copied into windows, after the partial aggregation."""
    plan = window_membership(spark.range(1000).toDF("t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("partial_count")


def fitted(df, end, estimator):
    columns = [*FEATURES, "y"]
    rows = df.dropna(subset=columns)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    train = fixed_layout(rows.filter(f"t >= {end - 100} AND t < {end}").select("t", *columns))
    model = estimator.fit(vectors.transform(train))
    return model.transform(vectors.transform(rows.filter(f"t >= {end} AND t < {end + 20}")))


def mean_error(scored):
    rows = scored.collect()
    errors = [abs(r["y"] - r["prediction"]) for r in rows]
    return sum(errors) / len(errors), sum(r["prediction"] for r in rows) / len(rows)


def test_linear_evaluation_equals_one_library_fit_per_window(spark):
    times = [*range(0, 230), *range(236, 300)]
    df = series(spark, times, missing={17, 150, 151}).cache()
    got = {r["t_end"]: (r["mae"], r["mean_pred"]) for r in walk_forward_linear(df).collect()}
    assert sorted(got) == list(range(100, 299, 20))
    for end in (100, 160, 220, 280):
        scored = fitted(df, end, LinearRegression(featuresCol="features", labelCol="y", solver="normal"))
        assert got[end] == pytest.approx(mean_error(scored), rel=1e-7)


def test_constant_feature_gets_no_weight(spark):
    df = series(spark, range(160)).withColumn("hour", F.lit(7))
    with_it = {r["t_end"]: r["mae"] for r in walk_forward_linear(df).collect()}
    without = {r["t_end"]: r["mae"] for r in walk_forward_linear(df, ["requests", "size", "y_lag1"]).collect()}
    assert with_it == pytest.approx(without)
    assert all(math.isfinite(v) for v in with_it.values())


def test_linear_evaluation_survives_a_large_offset(spark):
    df = series(spark, range(160))
    shifted = df.selectExpr("t", "requests", "size + 1e7 AS size", "hour", "y_lag1 + 1e7 AS y_lag1", "y + 1e7 AS y")
    plain = {r["t_end"]: r["mae"] for r in walk_forward_linear(df).collect()}
    moved = {r["t_end"]: r["mae"] for r in walk_forward_linear(shifted).collect()}
    assert moved == pytest.approx(plain, rel=1e-4)


def evaluated(spark, df, folder, **options):
    path = store_series(df, str(folder / "series"))
    metrics = evaluate_forest(spark, path, str(folder / "metrics"), **options)
    return {r["t_end"]: (r["mae"], r["mean_pred"], r["complete"]) for r in metrics.collect()}


def test_forest_equals_one_library_fit_per_window_and_repeats(spark, tmp_path):
    df = series(spark, [*range(0, 150), *range(400, 441)], missing={17}).cache()
    first = evaluated(spark, df, tmp_path / "a")
    assert sorted(first) == [100, 120, 140, 420]
    assert evaluated(spark, df.repartition(5), tmp_path / "b", parallelism=1) == first
    for end, (mae, mean_pred, _) in first.items():
        forest = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=10, seed=42)
        assert (mae, mean_pred) == pytest.approx(mean_error(fitted(df, end, forest)), rel=1e-12)


def test_only_windows_without_a_final_score_are_fitted(spark, tmp_path):
    short = evaluated(spark, series(spark, range(130)), tmp_path)
    assert {end: complete for end, (_, _, complete) in short.items()} == {100: True, 120: False}
    long = evaluated(spark, series(spark, range(150)), tmp_path)
    assert {end: complete for end, (_, _, complete) in long.items()} == {100: True, 120: True, 140: False}
    assert long[100] == short[100] and long[120] != short[120]
    parts = spark.read.parquet(str(tmp_path / "metrics"))
    assert sorted((r["part"], r["t_end"]) for r in parts.collect()) == [(0, 100), (0, 120), (1, 120), (1, 140)]


def test_a_run_without_new_rows_writes_nothing(spark, tmp_path):
    df = series(spark, range(120))
    first = evaluated(spark, df, tmp_path)
    assert {end: c for end, (_, _, c) in first.items()} == {100: True}
    assert evaluated(spark, df, tmp_path) == first
    assert spark.read.parquet(str(tmp_path / "metrics")).select("part").distinct().count() == 1


def test_the_last_score_of_a_window_counts(spark, tmp_path):
    path = str(tmp_path / "m")
    schema = ML_PERFORMANCE
    for part, mae in enumerate((3.0, 1.0, 2.0)):
        write_part(spark.createDataFrame([(100, 100, 20, True, 7, 8, mae, 0.0, 0, None)], schema), path, part)
    assert [r["mae"] for r in stored_metrics(spark, path).collect()] == [2.0]


def test_large_train_sets_are_spread_in_a_fixed_way(spark, monkeypatch):
    from tidegauge.plans import walk_forward_forest as module

    monkeypatch.setattr(module, "ROWS_PER_LOT", 10)
    copies = series(spark, [199] * 101).dropDuplicates(["t"]).crossJoin(spark.range(101)).drop("id")
    df = series(spark, range(199)).unionByName(copies)

    def layout(rows):
        return [[r["t"] for r in part] for part in fixed_layout(rows, 6).rdd.glom().collect()]

    tasks = layout(df)
    assert tasks == layout(df.repartition(7)) and len(tasks) == 6
    assert sorted(t for task in tasks for t in task) == sorted([*range(199), *[199] * 101])
    assert max(task.count(199) for task in tasks) < 101


def test_grouped_forest_is_as_good_as_the_library_forest(spark, tmp_path):
    df = series(spark, range(400))
    library = evaluated(spark, df, tmp_path)
    grouped = {r["t_end"]: r["mae"] for r in walk_forward_forest_grouped(df).collect()}
    assert grouped.keys() == library.keys()
    ratio = sum(grouped.values()) / sum(mae for mae, _, _ in library.values())
    assert 0.85 < ratio < 1.15


def test_grouped_forest_repeats_on_any_layout_and_skips_incomplete_rows(spark):
    df = series(spark, [*range(150), *range(400, 441)], missing={17})
    first = {r["t_end"]: r["mae"] for r in walk_forward_forest_grouped(df).collect()}
    again = walk_forward_forest_grouped(df.repartition(5).filter("t != 17"))
    assert sorted(first) == [100, 120, 140, 420]
    assert {r["t_end"]: r["mae"] for r in again.collect()} == pytest.approx(first, rel=1e-12)


def test_grouped_forest_learns_a_step(spark):
    df = spark.range(160).selectExpr("id AS t", "CAST(id % 7 AS DOUBLE) AS x", "if(id % 7 < 3, 10D, 20D) AS y")
    got = walk_forward_forest_grouped(df, ["x"]).collect()
    assert [r["t_end"] for r in got] == [100, 120, 140] and all(r["mae"] < 1e-9 for r in got)


def test_grouped_forest_without_any_split_predicts_the_mean(spark):
    df = spark.range(121).selectExpr("id AS t", "CAST(id % 7 AS DOUBLE) AS x", "5D AS y")
    assert [tuple(r) for r in walk_forward_forest_grouped(df, ["x"]).collect()] == [(100, 0.0, 5.0)]


def test_grouped_forest_keeps_windows_that_no_tree_draws_from(spark):
    """Every window trains on one row, and with one tree a third of them draw nothing."""
    df = spark.range(60).selectExpr("id * 10 AS t", "CAST(id AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y")
    got = walk_forward_forest_grouped(df, ["x"], window_size=10, batch_size=10, num_trees=1).collect()
    assert {r["t_end"]: (r["mae"], r["mean_pred"]) for r in got} == {
        10 * k: (1.0, k - 1.0) for k in range(1, 59)
    }


def test_grouped_forest_takes_repeated_times(spark):
    """Three rows per time, some equal and some not, and gaps in time: each row is drawn for itself."""
    once = series(spark, [t for t in range(160) if t % 9])
    moved = once.withColumn("y", F.col("y") + 1).withColumn("size", F.col("size") + 1)
    df = once.unionByName(once).unionByName(moved)
    first = {r["t_end"]: (r["mae"], r["mean_pred"]) for r in walk_forward_forest_grouped(df).collect()}
    assert sorted(first) == [100 + once.first()["t"], 120 + once.first()["t"], 140 + once.first()["t"]]
    again = {r["t_end"]: (r["mae"], r["mean_pred"]) for r in walk_forward_forest_grouped(df.repartition(7)).collect()}
    assert {end: pytest.approx(scores) for end, scores in first.items()} == again
    ranks = ranked_rows(df.select("t", "y", "size")).collect()
    by_time = {}
    for r in sorted(ranks, key=lambda r: (r["t"], r["nth"])):
        by_time.setdefault(r["t"], []).append((r["nth"], r["y"]))
    assert all([n for n, _ in rows] == [0, 1, 2] and [y for _, y in rows] == sorted(y for _, y in rows) for rows in by_time.values())


@pytest.mark.parametrize("size", [1e-6, 1e15])
def test_grouped_forest_scales_with_the_target(spark, size):
    df = series(spark, range(125))
    plain = walk_forward_forest_grouped(df).first()
    scaled = walk_forward_forest_grouped(df.withColumn("y", F.col("y") * size).withColumn("y_lag1", F.col("y_lag1") * size)).first()
    assert (scaled["mae"] / size, scaled["mean_pred"] / size) == pytest.approx((plain["mae"], plain["mean_pred"]), rel=1e-6)


def test_late_rows_lead_to_a_new_score(spark, tmp_path):
    late = set(range(30, 45))
    early = evaluated(spark, series(spark, [t for t in range(125) if t not in late]), tmp_path)
    after = evaluated(spark, series(spark, range(125)), tmp_path)
    fresh = evaluated(spark, series(spark, range(125)), tmp_path / "fresh")
    assert after == fresh and early[100] != after[100]


def test_ends_stay_where_they_are_when_old_rows_go(spark, tmp_path):
    evaluated(spark, series(spark, range(160)), tmp_path)
    left = series(spark, range(185)).filter("t >= 7")
    after = evaluated(spark, left, tmp_path)
    assert sorted(after) == [100, 120, 140, 160, 180]
    anew = evaluated(spark, left, tmp_path, restart_grid=True)
    assert sorted(set(anew) - set(after)) == [107, 127, 147, 167]
    # No window whose rows are all there was fitted again after the purge; 100 lost seven of its rows.
    parts = spark.read.parquet(str(tmp_path / "metrics")).filter("t_end = 120")
    assert parts.count() == 1


def test_nothing_stored_is_nothing_to_evaluate(spark, tmp_path):
    for evaluate in (evaluate_forest, evaluate_forest_grouped):
        got = evaluate(spark, str(tmp_path / "none"), str(tmp_path / "metrics"))
        assert got.count() == 0 and got.columns == [f.split()[0] for f in ML_PERFORMANCE.split(", ")]


def test_large_times_fall_into_their_blocks(spark):
    base = 2**60
    df = spark.createDataFrame([(base + t,) for t in range(121)], "t BIGINT")
    assert [tuple(r) for r in window_membership(df).collect()] == [(base + 100, 100, 20, True)]


def test_grouped_evaluation_is_incremental(spark, tmp_path):
    def run(n):
        path = store_series(series(spark, range(n)), str(tmp_path / "series"))
        metrics = evaluate_forest_grouped(spark, path, str(tmp_path / "metrics"))
        return {r["t_end"]: (r["mae"], r["complete"]) for r in metrics.collect()}

    short = run(130)
    assert {end: c for end, (_, c) in short.items()} == {100: True, 120: False}
    long = run(150)
    assert {end: c for end, (_, c) in long.items()} == {100: True, 120: True, 140: False}
    assert long[100] == short[100] and long[120] != short[120]
    assert run(150) == long
