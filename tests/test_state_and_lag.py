from __future__ import annotations

import datetime
import random

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidegauge.functions import epoch_units, from_epoch_units, iso_text, parse_iso
from tidegauge.operators.lag import with_lag
from tidegauge.operators.latest import absent_from, compact, latest_rows, read_replacing
from tidegauge.operators.retention import retained
from tidegauge.operators.state import latest_state, seeded
from tidegauge.operators.trend import newest_totals, trend_line
from tidegauge.operators.aggregates import totals
from tidegauge.plans.requests import LOG_KEY, binned_series, stored_log
from tidegauge.plans.sales import sales_trend
from tidegauge.schemas import METADATA, REQUEST_LOG, REQUEST_LOGS, SALES_STATS
from tidegauge.sinks import write_part

NOON = datetime.datetime(2024, 5, 1, 12)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def log_row(t, y, timestamp="2024-05-01T12:00:00", lag=0.0):
    return (timestamp, t, 12, 50, 100.0, float(y), lag, 0.5)


def plain_lag(series, seed):
    ordered = sorted(series)
    return {t: (ordered[i - 1][1] if i else seed) for i, (t, _) in enumerate(ordered)}


@FEW
@given(
    times=st.lists(st.integers(-60, 200), unique=True, min_size=1, max_size=40),
    stretch=st.sampled_from([1, 7, 1000]),
    levels=st.integers(0, 3),
)
def test_lag_is_the_plain_lag_however_it_is_split(spark, times, stretch, levels):
    series = [(t, float(random.Random(t).randint(0, 99))) for t in times]
    df = spark.createDataFrame(series, "t BIGINT, y DOUBLE")
    got = with_lag(df, "y", 0.0, stretch=stretch, levels=levels)
    assert {r["t"]: r["y_lag1"] for r in got.collect()} == plain_lag(series, 0.0)


def test_lag_keeps_a_null_value_and_separates_series(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 9, 2.0), ("a", 25, 3.0), ("b", 2, 7.0), ("b", 30, 8.0)], "k STRING, t BIGINT, y DOUBLE"
    )
    got = with_lag(df, "y", -1.0, keys=["k"], stretch=10)
    assert {(r["k"], r["t"]): r["y_lag1"] for r in got.collect()} == {
        ("a", 1): -1.0,
        ("a", 9): None,
        ("a", 25): 2.0,
        ("b", 2): -1.0,
        ("b", 30): 7.0,
    }


def test_lag_of_rows_without_time_or_key_equals_duckdb(spark):
    rows = [("a", 1, 1.0), ("a", 2, None), ("a", None, 5.0), (None, 3, 7.0), (None, 40, 8.0), ("b", None, 9.0)]
    got = with_lag(spark.createDataFrame(rows, "k STRING, t BIGINT, y DOUBLE"), "y", 0.0, keys=["k"], stretch=10)
    con = duckdb.connect()
    con.execute("CREATE TABLE s (k VARCHAR, t BIGINT, y DOUBLE)")
    con.executemany("INSERT INTO s VALUES (?, ?, ?)", rows)
    want = con.execute(
        "SELECT k, t, y, CASE WHEN row_number() OVER w = 1 THEN 0.0 ELSE lag(y) OVER w END AS y_lag1 "
        "FROM s WINDOW w AS (PARTITION BY k ORDER BY t NULLS LAST)"
    ).fetchall()
    assert sorted(map(repr, map(tuple, got.select("k", "t", "y", "y_lag1").collect()))) == sorted(map(repr, want))


def test_a_request_without_a_value_is_a_request(spark):
    rows = [(NOON, 2.0), (NOON, None), (NOON.replace(hour=13), None), (None, 1.0)]
    got = binned_series(spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, value DOUBLE"), "ts", "value", scale=2)
    assert {(r["requests"], r["size"], r["y"]) for r in got.collect()} == {(2, 1.0, 2.0), (1, None, None), (1, 1.0, 1.0)}


def test_values_finer_than_the_scale_are_an_error(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 1.005)], "item STRING, amount DOUBLE")
    with pytest.raises(Exception, match="more than 2 decimals"):
        totals(df, scale=2).collect()
    assert totals(df, scale=3).first()["total_amount"] == 2.255


def test_epoch_units_round_down_on_both_sides_of_the_epoch(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'1969-12-31 23:59:59.5' AS ts UNION ALL SELECT timestamp_ntz'1970-01-02 01:02:03.9'"
    )
    units = ["SECOND", "MINUTE", "HOUR", "DAY"]
    got = {tuple(r) for r in df.select(*[epoch_units("ts", u) for u in units]).collect()}
    assert got == {(-1, -1, -1, -1), (90123, 1502, 25, 1)}
    back = df.select(epoch_units("ts").alias("s")).select(from_epoch_units("s").alias("ts"))
    assert {r[0] for r in back.collect()} == {
        datetime.datetime(1969, 12, 31, 23, 59, 59),
        datetime.datetime(1970, 1, 2, 1, 2, 3),
    }


def test_iso_text_there_and_back(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS ts")
    text = df.select(iso_text("ts").alias("text"), parse_iso(iso_text("ts")).alias("ts"))
    assert text.first()["text"] == "2024-03-10T02:30:00.123456"
    assert text.first()["ts"] == datetime.datetime(2024, 3, 10, 2, 30, 0, 123456)
    zoned = spark.sql("SELECT '2026-03-01T12:00:00+00:00' AS x")
    assert zoned.select(parse_iso("x")).first()[0] == datetime.datetime(2026, 3, 1, 12)
    assert spark.sql("SELECT 'no time' AS x").select(parse_iso("x")).first()[0] is None


def test_replacing_key_is_a_parameter(spark):
    log = spark.createDataFrame([log_row(t, t) for t in range(60)], REQUEST_LOG)
    stored = stored_log(log, NOON)
    assert latest_rows(stored, LOG_KEY, []).count() == 60
    by_timestamp = latest_rows(stored, ["timestamp"], ["t"])
    assert [r["t"] for r in by_timestamp.collect()] == [59]


def test_latest_row_is_the_greatest_version_and_needs_no_window(spark):
    df = spark.createDataFrame([(k % 3, v, -v) for k, v in enumerate(range(100))], "k INT, v INT, x INT")
    got = latest_rows(df, ["k"], ["v"])
    assert sorted(tuple(r) for r in got.collect()) == [(0, 99, -99), (1, 97, -97), (2, 98, -98)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max" in plan


def test_later_parts_replace_earlier_rows(spark, tmp_path):
    path, merged = str(tmp_path / "logs"), str(tmp_path / "merged")
    assert read_replacing(spark, path, REQUEST_LOGS, LOG_KEY).count() == 0
    for part, (low, high, y) in enumerate([(0, 10, 1), (5, 15, 2)]):
        rows = spark.createDataFrame([log_row(t, y) for t in range(low, high)], REQUEST_LOG)
        write_part(stored_log(rows, NOON), path, part)
    expected = {t: 1.0 if t < 5 else 2.0 for t in range(15)}

    def stored(where):
        table = read_replacing(spark, where, REQUEST_LOGS, LOG_KEY)
        assert "y_lag1" not in table.columns and dict(table.dtypes)["hour"] == "tinyint"
        return {r["t"]: r["y"] for r in table.collect()}

    assert stored(path) == expected
    compact(spark, path, merged, REQUEST_LOGS, LOG_KEY)
    assert stored(merged) == expected
    write_part(stored_log(spark.createDataFrame([log_row(3, 9)], REQUEST_LOG), NOON), merged, 1)
    assert stored(merged) == {**expected, 3: 9.0}


def test_absent_from(spark):
    ids = spark.range(10)
    assert sorted(r[0] for r in absent_from(ids, spark.range(3, 8), ["id"]).collect()) == [0, 1, 2, 8, 9]


def test_seed_does_not_replace_state_and_a_rerun_changes_nothing(spark):
    updates = spark.createDataFrame(
        [("last_y", 1.0, NOON), ("last_y", 5.0, NOON + datetime.timedelta(hours=1)), ("other", 2.0, NOON)], METADATA
    )
    seeds = [("last_y", 0.0, NOON), ("new", 0.0, NOON)]
    once = seeded(latest_state(updates), seeds)
    assert {r["key"]: r["value"] for r in once.collect()} == {"last_y": 5.0, "other": 2.0, "new": 0.0}
    assert sorted(map(tuple, seeded(once, seeds).collect())) == sorted(map(tuple, once.collect()))


def test_retention_counts_whole_minutes_and_reaches_the_scan(spark, tmp_path):
    newest = datetime.datetime(2024, 5, 8, 12)
    ages = [0, 10080 * 60, 10080 * 60 + 59, 10081 * 60, 10081 * 60 + 1]
    df = spark.createDataFrame([(newest - datetime.timedelta(seconds=a), a) for a in ages], "ts TIMESTAMP_NTZ, age INT")
    path = str(tmp_path / "t")
    df.write.parquet(path)
    for kept in (retained(spark.read.parquet(path)), retained(spark.read.parquet(path), now=newest)):
        assert {r["age"] for r in kept.collect()} == set(ages[:3])
        assert "GreaterThan(ts," in kept._jdf.queryExecution().executedPlan().toString()
    assert retained(spark.createDataFrame([], "ts TIMESTAMP_NTZ")).count() == 0


def stats(spark, amounts):
    return spark.createDataFrame(
        [(f"i{k:03d}", float(a), NOON + datetime.timedelta(minutes=k // 2)) for k, a in enumerate(amounts)], SALES_STATS
    )


def test_trend_counts_from_the_newest_total(spark):
    table = stats(spark, range(150)).repartition(7)
    points = newest_totals(table, ["processed_at", "item"])
    assert {r["index"]: r["amount"] for r in points.collect()} == {i: 149.0 - i for i in range(100)}
    line = sales_trend(table).first()
    assert abs(line["coeff"] + 1) < 1e-9 and abs(line["intercept"] - 149) < 1e-9


def test_trend_needs_two_points(spark):
    assert sales_trend(stats(spark, [])).count() == 0
    assert sales_trend(stats(spark, [5])).count() == 0
    assert sales_trend(stats(spark, [5, 7])).count() == 1


def test_trend_equals_the_library_regression(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    points = newest_totals(stats(spark, [(k * 37) % 101 for k in range(120)]), ["processed_at", "item"])
    model = LinearRegression(featuresCol="features", labelCol="amount").fit(
        VectorAssembler(inputCols=["index"], outputCol="features").transform(points)
    )
    line = trend_line(points).first()
    assert abs(line["coeff"] - model.coefficients[0]) < 1e-9
    assert abs(line["intercept"] - model.intercept) < 1e-7
