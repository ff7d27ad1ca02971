"""Models that are kept score as they did, and no window is fitted twice; a corrected row leads to a new score."""

from __future__ import annotations

import json

import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tidegauge import jobs
from tidegauge.constants import FEATURES, LABEL
from tidegauge.operators.windows import WindowGrid, checked_windows, window_membership
from tidegauge.plans.models import ModelStore, fingerprint, predicted
from tidegauge.plans.walk_forward_forest import default_forest, evaluate_forest, kept_models, store_series
from tidegauge.sources import stream_json_lines
from tidegauge.streaming import stream_scores

SCHEMA = "t long, requests long, size double, hour int, y_lag1 double, y double"


def rows(n):
    return [(t, 40 + t * 7 % 30, 100.0 + t % 9, t % 24, float((t - 1) % 11), float(t % 11 + t % 24)) for t in range(n)]


@pytest.fixture
def fits(monkeypatch):
    """Ends of the train parts that were fitted, in any order."""
    seen = []
    fit = RandomForestRegressor.fit

    def counted(self, df, *more):
        seen.append(df.agg(F.max("t")).first()[0] + 1)
        return fit(self, df, *more)

    monkeypatch.setattr(RandomForestRegressor, "fit", counted)
    return seen


@pytest.fixture
def places(spark, tmp_path):
    def series(data, name):
        return store_series(spark.createDataFrame(data, SCHEMA), str(tmp_path / name))

    return series, str(tmp_path / "models"), lambda name: str(tmp_path / name)


def metrics_of(df):
    return sorted((r["t_end"], r["mae"], r["mean_pred"]) for r in df.collect())


def test_a_window_is_fitted_once(spark, places, fits):
    series, models, at = places
    first = metrics_of(evaluate_forest(spark, series(rows(165), "a"), at("m1"), models=models))
    assert sorted(fits) == [100, 120, 140, 160]
    # Other scores, the same models; more rows, one window more.
    assert metrics_of(evaluate_forest(spark, series(rows(165), "a"), at("m2"), models=models)) == first
    assert len(fits) == 4
    more = metrics_of(evaluate_forest(spark, series(rows(190), "b"), at("m1"), models=models))
    assert sorted(fits) == [100, 120, 140, 160, 180] and more[:3] == first[:3]
    assert more == metrics_of(evaluate_forest(spark, series(rows(190), "b"), at("m3")))
    # A value in the train part of one window has changed; another forest shares nothing.
    data = [(*r[:5], r[5] + 1 if r[0] == 5 else r[5]) for r in rows(165)]
    fits.clear()
    evaluate_forest(spark, series(data, "c"), at("m4"), models=models)
    assert fits == [100]
    evaluate_forest(spark, series(rows(125), "d"), at("m5"), models=models, seed=1)
    assert sorted(fits) == [100, 100, 120]


def test_reloaded_models_score_as_they_did(spark, places, fits):
    series, models, at = places
    path = series(rows(165), "a")
    metrics = metrics_of(evaluate_forest(spark, path, at("m1"), models=models))
    kept, done = kept_models(spark, models), len(fits)
    scored = kept.scored(spark.read.parquet(path), FEATURES)
    assert sorted(r["t"] for r in scored.collect()) == list(range(100, 165))
    error = scored.groupBy("t_end").agg(F.avg(F.abs(F.col(LABEL) - F.col("prediction"))).alias("mae"), F.avg("prediction").alias("mean_pred"))
    assert metrics_of(error)[:3] == metrics[:3]
    later = spark.createDataFrame([(500 + t, *r[1:]) for t, r in enumerate(rows(20))] + [(None, 1, 1.0, 1, 1.0, 1.0), (501, None, 1.0, 1, 1.0, 1.0)], SCHEMA)
    assert {r["t_end"] for r in kept.scored(later, FEATURES).collect()} == {160} and kept.scored(later, FEATURES).count() == 20
    assert kept.newest()[0] == 160 and kept.newest(139)[0] == 120 and kept.newest(99) is None
    assert kept.scored(later.limit(0), FEATURES).count() == 0 and kept_models(spark, at("none")).newest() is None
    assert kept_models(spark, at("none")).scored(later, FEATURES).columns == [*later.columns, "prediction", "t_end"]
    assert len(fits) == done


def log_line(r):
    return json.dumps(dict(timestamp="2024-05-01T12:00:00", t=r[0], requests=r[1], size=r[2], hour=r[3], y_lag1=r[4], y=r[5], drift_factor=0.1))


def test_a_stream_is_scored_without_a_fit(spark, places, fits, tmp_path):
    series, models, at = places
    evaluate_forest(spark, series(rows(125), "a"), at("m1"), models=models)
    done = len(fits)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text("\n".join(map(log_line, rows(40))) + "\nBROKEN\n")
    jobs.main(["score-requests", "--models", models, "--source", at("in"), "--table", at("scores"), "--checkpoint", at("c")])
    end, model = kept_models(spark, models).newest()
    want = predicted(model, spark.createDataFrame(rows(40), SCHEMA), FEATURES)
    assert end == 120 and len(fits) == done
    assert {r["t"]: r["prediction"] for r in spark.read.parquet(at("scores")).collect()} == {r["t"]: r["prediction"] for r in want.collect()}
    jobs.main(["score-requests", "--models", models, "--series", at("a"), "--table", at("later")])
    assert spark.read.parquet(at("later")).count() == 25
    with pytest.raises(SystemExit):
        jobs.main(["score-requests", "--models", models, "--table", at("x")])


def test_a_corrected_row_leads_to_a_new_score(spark, places):
    series, _, at = places
    before = metrics_of(evaluate_forest(spark, series(rows(165), "a"), at("m")))
    data = [(*r[:5], r[5] + 50 if r[0] == 130 else r[5]) for r in rows(165)]
    after = metrics_of(evaluate_forest(spark, series(data, "b"), at("m")))
    assert [a[0] for a, b in zip(before, after, strict=True) if a != b] == [120, 140, 160]
    assert after == metrics_of(evaluate_forest(spark, series(data, "b"), at("fresh")))


def test_checksums(spark):
    data = spark.createDataFrame(rows(165) + [rows(165)[3]], SCHEMA)
    grid = WindowGrid(data)
    first = {r["t_end"]: r for r in checked_windows(data, grid, [*FEATURES, LABEL]).collect()}
    again = {r["t_end"]: r for r in checked_windows(data.repartition(7), grid, [*FEATURES, LABEL]).collect()}
    assert first == again and len({r["train_sum"] for r in first.values()}) == len(first)
    plain = window_membership(data, grid).collect()
    assert {tuple(r) for r in plain} == {(r["t_end"], r["n_train"], r["n_test"], r["complete"]) for r in first.values()}
    # Two equal rows are not the same as none.
    fewer = {r["t_end"]: r for r in checked_windows(data.distinct(), grid, [*FEATURES, LABEL]).collect()}
    assert fewer[100]["train_sum"] != first[100]["train_sum"] and fewer[140] == first[140]


def test_fingerprints():
    base = fingerprint(default_forest(), FEATURES, LABEL, 4)
    others = [fingerprint(default_forest(11), FEATURES, LABEL, 4), fingerprint(default_forest(), FEATURES[:2], LABEL, 4), fingerprint(default_forest(), FEATURES, "z", 4), fingerprint(default_forest(), FEATURES, LABEL, 5)]
    assert len({base, *others}) == 5 and base == fingerprint(default_forest(), FEATURES, LABEL, 4)


def test_an_index_that_a_run_did_not_reach_is_no_loss(spark, places, fits, monkeypatch):
    series, models, at = places
    add = ModelStore.add
    monkeypatch.setattr(ModelStore, "add", lambda self, fitted: (_ for _ in ()).throw(OSError("cut off")))
    with pytest.raises(OSError):
        evaluate_forest(spark, series(rows(125), "a"), at("m"), models=models)
    monkeypatch.setattr(ModelStore, "add", add)
    assert kept_models(spark, models).newest() is None
    evaluate_forest(spark, series(rows(125), "a"), at("m2"), models=models)
    assert sorted(fits) == [100, 100, 120, 120] and kept_models(spark, models).newest()[0] == 120
