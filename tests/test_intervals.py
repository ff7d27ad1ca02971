"""The range join against all pairs."""

from __future__ import annotations

import random

import pytest

from tidegauge.functions import floor_div
from tidegauge.operators.intervals import FANOUT, in_bins, interval_join
from tidegauge.operators.windows import window_rows_at

LOW, HIGH = -(2**63), 2**63 - 1


@pytest.fixture(scope="module")
def made():
    r = random.Random(1)
    points = [(i, r.choice((r.randint(-1000, 5000), r.randint(-(2**62), 2**62), None, HIGH, LOW, 17))) for i in range(400)]
    intervals = []
    for j in range(300):
        a = r.choice((r.randint(-1000, 5000), r.randint(-(2**62), 2**62), LOW, 17))
        intervals.append((j, a, max(min(a + r.choice((0, -5, 1, 3, 20, 100, 5000, 2**40, 2**62)), HIGH), LOW)))
    return points, intervals + [(1000, None, 5), (1001, 5, None), (1002, LOW, HIGH), (3, 0, 50), (3, 0, 50)]


def frames(spark, points, intervals):
    return spark.createDataFrame(points, "i long, t long"), spark.createDataFrame(intervals, "j long, low long, high long")


@pytest.mark.parametrize("narrowest", [None, 1, 7, 1000, 1 << 40])
def test_pairs_of_any_lengths(spark, made, narrowest):
    points, intervals = made
    want = sorted((i, j) for i, t in points for j, a, b in intervals if None not in (t, a, b) and a <= t < b)
    got = interval_join(*frames(spark, points, intervals), "t", "low", "high", narrowest=narrowest)
    assert got.columns == ["i", "t", "j", "low", "high"]
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want


def test_no_nested_loop_and_few_bins(spark, made):
    points, intervals = frames(spark, *made)
    plan = interval_join(points, intervals, "t", "low", "high")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    copies = in_bins(intervals, "low", "high", 1).groupBy("j", "low", "high").count().where("j <> 3").agg({"count": "max"}).first()[0]
    assert copies <= 2 * FANOUT


def test_nothing_meets_nothing(spark, made):
    points, intervals = frames(spark, *made)
    for some, others in ((points.limit(0), intervals), (points, intervals.limit(0)), (points, intervals.where("low >= high"))):
        assert interval_join(some, others, "t", "low", "high").count() == 0


def test_floor_division_over_the_whole_range(spark):
    values = [LOW, LOW + 1, -17, -16, -1, 0, 1, 16, 17, HIGH]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for by in (1, 2, 16, 1 << 60):
        assert [r[0] for r in df.select(floor_div(df["v"], by)).collect()] == [v // by for v in values]


def test_windows_at_any_ends(spark):
    rows = spark.createDataFrame([(t, float(t)) for t in range(40)], "t long, y double")
    ends = spark.createDataFrame([(10, 0, 13), (11, 11, 12), (30, 5, 30), (100, 39, 200)], "t_end long, train_from long, test_until long")
    got = sorted((r["t_end"], r["t"], r["is_train"]) for r in window_rows_at(rows, ends).collect())
    assert got == sorted([(10, t, t < 10) for t in range(13)] + [(11, 11, False)] + [(30, t, True) for t in range(5, 30)] + [(100, 39, True)])
