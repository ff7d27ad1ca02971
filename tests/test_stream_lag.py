"""Lags over a stream equal the batch lag, and late rows and rows without a time change nothing."""

from __future__ import annotations

import json
import os
import random

import pytest

from tidegauge import jobs
from tidegauge.operators.lag import with_lag
from tidegauge.sources import stream_json_lines
from tidegauge.streaming import stored_lags, stream_lagged
from tidegauge.streaming.lag import IN_ORDER, LATE, UNTIMED

SCHEMA = "k STRING, t BIGINT, y DOUBLE"


@pytest.fixture
def stream(spark, tmp_path):
    """A function that adds files of rows, runs the stream to its end, and gives all that was stored."""
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "checkpoint")
    source.mkdir()

    def run(*files, **options):
        for rows in files:
            number = len(list(source.glob("*.json")))
            path = source / f"{number:04}.json"
            path.write_text("".join(json.dumps(dict(zip(("k", "t", "y"), r, strict=True))) + "\n" for r in rows))
            os.utime(path, (10**9 + number, 10**9 + number))
        rows = stream_json_lines(spark, str(source), SCHEMA, max_files=1).rows
        stream_lagged(rows, table, checkpoint, "y", -1.0, keys=["k"], partitions=2, **options).awaitTermination()
        return sorted((tuple(r) for r in spark.read.parquet(table).select("k", "t", "y", "y_lag1", "place").collect()), key=repr)

    run.checkpoint = checkpoint
    return run


def batch_lag(spark, rows):
    found = with_lag(spark.createDataFrame(rows, SCHEMA), "y", -1.0, keys=["k"])
    return sorted(((*r, IN_ORDER) for r in found.select("k", "t", "y", "y_lag1").collect()), key=repr)


def series(n, seed):
    r = random.Random(seed)
    return [(r.choice(("a", "b", None)), t, r.choice((None, float(r.randint(0, 99))))) for t in range(n)]


def test_batches_and_runs_give_the_batch_lag(spark, stream):
    rows = series(120, 1)
    shuffled = [random.Random(k).sample(part, len(part)) for k, part in enumerate((rows[:40], rows[40:41], rows[41:100]))]
    assert stream(*shuffled) == batch_lag(spark, rows[:100])
    assert stream() == batch_lag(spark, rows[:100])
    assert stream(rows[100:]) == batch_lag(spark, rows)
    last = {json.loads(r["series"]).get("k0"): (r["t"], r["value"]) for r in stored_lags(spark, stream.checkpoint).collect()}
    assert last == {k: next((t, y) for key, t, y in reversed(rows) if key == k) for k in ("a", "b", None)}


def test_rows_wait_for_earlier_ones(spark, stream):
    rows = [("a", t, float(t)) for t in range(60)]
    r = random.Random(2)
    arrival = sorted(rows, key=lambda row: row[1] + r.randint(0, 5))
    got = stream(arrival[:20], arrival[20:30], delay=5)
    youngest = max(t for _, t, _ in arrival[:30])
    assert got == [row for row in batch_lag(spark, rows) if row[1] <= youngest - 5]
    got = stream(arrival[30:], delay=5)
    assert got == [row for row in batch_lag(spark, rows) if row[1] <= 54]
    # What still waits goes on with the next row of its series.
    assert stream([("a", 1000, 7.0)], delay=5) == batch_lag(spark, rows)


def test_late_repeated_and_untimed_rows(spark, stream):
    got = stream([("a", 5, 1.0), ("a", 5, 2.0), ("a", 9, 3.0), ("a", None, 4.0)], [("a", 7, 5.0), ("a", 9, 3.0), ("a", 2**60, 6.0), ("b", 1, None)], [("b", 2, 8.0)])
    assert got == sorted(
        [("a", 5, 1.0, -1.0, IN_ORDER), ("a", 5, 2.0, None, LATE), ("a", 9, 3.0, 1.0, IN_ORDER), ("a", None, 4.0, None, UNTIMED)]
        + [("a", 7, 5.0, None, LATE), ("a", 9, 3.0, None, LATE), ("a", 2**60, 6.0, 3.0, IN_ORDER), ("b", 1, None, -1.0, IN_ORDER), ("b", 2, 8.0, None, IN_ORDER)],
        key=repr,
    )


def test_the_batch_lag_of_rows_of_one_time_does_not_depend_on_their_order(spark):
    rows = [("a", t // 3, float(t % 3)) for t in range(30)]
    want = [("a", t // 3, float(t % 3), -1.0 if not t else float((t - 1) % 3)) for t in range(30)]
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(rows, 30), SCHEMA).repartition(5)
        assert sorted(map(tuple, with_lag(df, "y", -1.0, keys=["k"], stretch=4).collect())) == sorted(want)


def test_the_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = [json.dumps(dict(timestamp="2024-05-01T12:00:00", t=t, hour=12, requests=50, size=100.0, y=float(t), y_lag1=0.0, drift_factor=0.1)) for t in range(10)]
    (tmp_path / "in" / "0.json").write_text("\n".join([*lines, "BROKEN", ""]))
    jobs.main(["stream-lags", "--source", str(tmp_path / "in"), "--table", str(tmp_path / "t"), "--checkpoint", str(tmp_path / "c"), "--partitions", "1"])
    assert sorted((r["t"], r["y_lag1"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(t, float(max(t - 1, 0))) for t in range(10)]
