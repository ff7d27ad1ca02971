"""The given tables in the form of the record types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.functions import epoch_units
from tidegauge.plans.requests import binned_series, request_features
from tidegauge.plans.walk_forward_forest import store_series
from tidegauge.scratch import fresh_folder
from tidegauge.sinks import write_snapshot
from tidegauge.sources import scan_table

# The values of ``events`` have two decimals.
SCALE = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("item"), F.col("value").alias("amount"), epoch_units("ts").alias("ts")
    )


def as_json(spark: SparkSession, df: DataFrame, label: str) -> str:
    path = fresh_folder(spark, label)
    # The default text of a timestamp ends at milliseconds.
    df.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return path


# Files that a table arrives in where a stream is to read it, and how many of them a batch takes.
FILES = 6
FILES_PER_BATCH = 2


def arriving(df: DataFrame, files: int = FILES) -> DataFrame:
    """The rows dealt out for so many files."""
    return df.repartition(files)


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour, stored: the scan of the events happens once, what follows reads the bins."""
    binned = binned_series(table(spark, sf_dir, "events"), "ts", "value", "HOUR", SCALE)
    return scan_table(spark, write_snapshot(binned, fresh_folder(spark, "hourly")))


def stored_features(spark: SparkSession, sf_dir: str) -> str:
    """Path of the hourly request log, sorted by time."""
    return store_series(request_features(hourly_series(spark, sf_dir)), fresh_folder(spark, "features"))


# SQL counterparts of the helpers above.
SALES_SQL = """sales AS (
    SELECT event_type AS item, value AS amount, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM events
)"""

LOG_SQL = """hourly AS (
    SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t,
           count(*) AS requests,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS y
    FROM events GROUP BY 1
),
log AS (
    SELECT TIMESTAMP '1970-01-01 00:00:00' + to_hours(t) AS "timestamp",
           t,
           CAST(t % 24 AS INTEGER) AS hour,
           requests,
           y / requests AS size,
           y,
           coalesce(lag(y) OVER (ORDER BY t), 0.0) AS y_lag1,
           sin(2 * pi() * t / 10000) AS drift_factor
    FROM hourly
)"""
