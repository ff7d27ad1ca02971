"""Request log: series, features and the stored table."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.constants import LAG_SEED, LAST_VALUE_KEY
from tidegauge.functions import (
    drift_factor,
    epoch_units,
    exact_sum,
    expected_rate,
    expected_target,
    from_epoch_units,
    hour_of_day,
    parse_iso,
)
from tidegauge.operators.daily import DailyTable
from tidegauge.operators.lag import with_lag
from tidegauge.operators.latest import read_parts
from tidegauge.operators.state import latest_state
from tidegauge.schemas import METADATA, REQUEST_LOG, REQUEST_LOGS, field_names
from tidegauge.sinks import stamped, write_lines, write_part
from tidegauge.sinks.tables import PART
from tidegauge.sources import scan_json_lines
from tidegauge.sources.json_lines import reject_rows, rejected_lines, split_rejects

# What both forms of the record have; the key is its first two.
STORED = tuple(c for c in field_names(REQUEST_LOGS) if c in field_names(REQUEST_LOG))
LOG_KEY = STORED[:2]


def binned_series(events: DataFrame, ts: str, value: str, unit: str = "HOUR", scale: int | None = None) -> DataFrame:
    """One row per time unit: number of requests, total of the value, and the total per request.

    Requests without a value count as requests; a unit in which none has one has no total.
    """
    binned = events.groupBy(epoch_units(ts, unit).alias("t")).agg(
        F.count(F.lit(1)).alias("requests"), exact_sum(value, scale).alias("y")
    )
    return binned.select("t", "requests", (F.col("y") / F.col("requests")).alias("size"), "y")


def request_features(series: DataFrame, unit: str = "HOUR", lag_seed: float = LAG_SEED) -> DataFrame:
    """A series in the form of the request log, its lag and drift included."""
    return (
        with_lag(series, "y", lag_seed)
        .withColumn("timestamp", from_epoch_units("t", unit))
        .withColumn("hour", hour_of_day("timestamp"))
        .withColumn("drift_factor", drift_factor())
        .select(*field_names(REQUEST_LOG))
    )


def with_expectations(log: DataFrame) -> DataFrame:
    """Add what the noise-free model expects, and how far the target is from it."""
    return (
        log.withColumn("expected_requests", expected_rate())
        .withColumn("expected_y", expected_target())
        .withColumn("residual", F.col("y") - F.col("expected_y"))
    )


def stored_log(log: DataFrame, processed_at: Column | datetime.datetime | None = None) -> DataFrame:
    """The request log in its stored types, without the lag."""
    typed = log.select(*STORED)
    if dict(log.dtypes)["timestamp"] == "string":
        typed = typed.withColumn("timestamp", parse_iso("timestamp"))
    return stamped(typed.withColumn("hour", F.col("hour").cast("tinyint")), processed_at)


def request_days(path: str) -> DailyTable:
    """The stored request log as a table kept by days."""
    return DailyTable(path, REQUEST_LOGS, LOG_KEY, "timestamp", ["processed_at"])


def checked_times(lines: DataFrame) -> DataFrame:
    """Lines whose time is no time are marked as rejects: as null keys they would replace each other."""
    return reject_rows(lines, parse_iso("timestamp").isNull())


def load_requests(
    spark: SparkSession,
    source: str,
    table: str,
    part: int,
    processed_at: Column | datetime.datetime | None = None,
    rejects: str | None = None,
    **options,
) -> bool:
    """Write the request log below ``source`` as one part; False when there is nothing to load.

    Lines that are no records go to the text table ``rejects`` under the same part number.
    ``options`` are those of `scan_json_lines`.
    """
    scan = split_rejects(checked_times(scan_json_lines(spark, source, REQUEST_LOG, **options).lines))
    if rejects is not None:
        write_lines(rejected_lines(scan.rejects), rejects, part)
    if scan.rows.isEmpty():
        return False
    write_part(stored_log(scan.rows, processed_at), table, part, sort_by=LOG_KEY)
    return True


def continued_features(
    spark: SparkSession, series: DataFrame, state: str, part: int, unit: str = "HOUR", lag_seed: float = LAG_SEED
) -> DataFrame:
    """Features of the next stretch of a series, its first lag taken from the state that the last one left.

    The newest target is then stored as part ``part`` of the state. ``series`` is read several times.
    """
    earlier = read_parts(spark, state, METADATA).filter(F.col(PART) < part)
    last = latest_state(earlier.filter(F.col("key") == LAST_VALUE_KEY), at="updated_at").first()
    log = request_features(series, unit, lag_seed if last is None else last["value"])
    newest = log.agg(F.max_by("y", "t").alias("value"), F.max("timestamp").alias("updated_at")).filter("updated_at IS NOT NULL")
    write_part(newest.select(F.lit(LAST_VALUE_KEY).alias("key"), "value", "updated_at"), state, part)
    return log


def ordered(series: DataFrame, by: Sequence[str] = ("t",)) -> DataFrame:
    """Full sort, distributed by ranges."""
    return series.orderBy(*by)
