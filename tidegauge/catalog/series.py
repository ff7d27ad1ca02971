"""The hourly request log: features and what the noise-free model expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import LOG_SQL, hourly_series
from tidegauge.functions import expected_rate
from tidegauge.plans import requests


def request_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = requests.request_features(hourly_series(spark, sf_dir))
    return log.withColumns(
        {"size": F.round("size", 6), "drift_factor": F.round("drift_factor", 9)}
    )


def ordered_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.ordered(hourly_series(spark, sf_dir)).select("t", "requests", "y")


def expected_rate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = requests.request_features(hourly_series(spark, sf_dir))
    return log.select("t", "hour", F.round(expected_rate(), 6).alias("expected_requests"))


def expected_and_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = requests.with_expectations(requests.request_features(hourly_series(spark, sf_dir)))
    return log.select("t", F.round("expected_y", 4).alias("expected_y"), F.round("residual", 4).alias("residual"))


QUERIES = {
    "request_features": request_features,
    "ordered_series": ordered_series,
    "expected_rate": expected_rate_query,
    "expected_and_residual": expected_and_residual,
}

ORACLES = {
    "request_features": f"""WITH {LOG_SQL}
SELECT "timestamp", t, hour, requests, round(size, 6) AS size, y, y_lag1, round(drift_factor, 9) AS drift_factor
FROM log""",
    "ordered_series": f"WITH {LOG_SQL} SELECT t, requests, y FROM log ORDER BY t",
    "expected_rate": f"""WITH {LOG_SQL}
SELECT t, hour, round(greatest(50 + 20 * sin(2 * pi() * hour / 24), 5), 6) AS expected_requests FROM log""",
    "expected_and_residual": f"""WITH {LOG_SQL},
expected AS (
    SELECT t, y, 0.5 * y_lag1 + (0.015 + 0.01 * drift_factor) * power(requests, 1.2) + 0.15 * size AS expected_y
    FROM log
)
SELECT t, round(expected_y, 4) AS expected_y, round(y - expected_y, 4) AS residual FROM expected""",
}
