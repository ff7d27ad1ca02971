"""A replacing table kept by days: a load rewrites only the days that it touches.

Loads are appended as numbered parts beside the table. A merge takes the parts that are whole at its start,
puts them into the days they touch, and replaces those days alone by Spark's dynamic partition overwrite; then
exactly these parts go. A part that arrives meanwhile is not among them and waits for the next merge. A merge that
breaks off after its write is repeated by the next one with the same result, as the parts are still there.

    table/days/day=2024-05-01/…    one row per key, sorted
    table/arrivals/part=7/…        loads that no merge has taken yet
    table/merging                  there while a merge runs

Reading merges what waits with the days it touches, and those only; other days are a plain scan.
The day must follow from the key, as it does where the key holds the time.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.files import Store
from tidegauge.operators.latest import latest_rows
from tidegauge.sinks import write_part
from tidegauge.sinks.tables import PART

DAY = "day"
#: Where rows without a time are kept.
NO_DAY = datetime.date(9999, 12, 31)
# Merged rows count as older than any load.
_MERGED = -1


class DailyTable(NamedTuple):
    """Place, columns as DDL, key and version of a table, and the column whose date is the day."""

    path: str
    schema: str
    key: Sequence[str]
    time: str
    version: Sequence[str] = ()

    @property
    def days(self) -> str:
        return f"{self.path}/days"

    @property
    def arrivals(self) -> str:
        return f"{self.path}/arrivals"

    @property
    def lock(self) -> str:
        return f"{self.path}/merging"

    def day(self) -> Column:
        return F.coalesce(F.col(self.time).cast("date"), F.lit(NO_DAY))


def add_load(df: DataFrame, table: DailyTable, part: int) -> None:
    """Append a load under its number; writing it again replaces it, later numbers win over earlier ones."""
    write_part(df, table.arrivals, part, table.key)


def whole_parts(spark: SparkSession, table: DailyTable) -> list[int]:
    """Numbers of the waiting loads whose write has ended."""
    store = Store(spark, table.path)
    numbers = [int(n.partition("=")[2]) for n in store.names(table.arrivals) if n.startswith(f"{PART}=")]
    return sorted(n for n in numbers if store.exists(f"{table.arrivals}/{PART}={n}/_SUCCESS"))


def _waiting(spark: SparkSession, table: DailyTable, parts: Sequence[int]) -> DataFrame:
    paths = [f"{table.arrivals}/{PART}={n}" for n in parts]
    rows = spark.read.schema(f"{table.schema}, {PART} BIGINT").option("basePath", table.arrivals).parquet(*paths)
    return rows.withColumn(DAY, table.day())


def _merged(spark: SparkSession, table: DailyTable) -> DataFrame:
    kept = f"{table.schema}, {DAY} DATE"
    try:
        return spark.read.schema(kept).parquet(table.days)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kept)


def _with_waiting(merged: DataFrame, waiting: DataFrame, table: DailyTable, days: list[datetime.date]) -> DataFrame:
    """The given days, as literals, so that the scan lists no others, with what waits for them."""
    touched = merged.filter(F.col(DAY).isin(days)).withColumn(PART, F.lit(_MERGED).cast("bigint"))
    return latest_rows(touched.unionByName(waiting), [DAY, *table.key], [PART, *table.version]).drop(PART)


def _days_of(waiting: DataFrame) -> list[datetime.date]:
    """The days that the waiting loads touch: a calendar's worth at most."""
    return [row[DAY] for row in waiting.select(DAY).distinct().collect()]


def read_daily(spark: SparkSession, table: DailyTable) -> DataFrame:
    """One row per key, with its ``day``; a table that nothing was loaded into has no rows."""
    parts, merged = whole_parts(spark, table), _merged(spark, table)
    if not parts:
        return merged
    waiting = _waiting(spark, table, parts)
    days = _days_of(waiting)
    return merged.filter(~F.col(DAY).isin(days)).unionByName(_with_waiting(merged, waiting, table, days))


def merge_loads(spark: SparkSession, table: DailyTable) -> int:
    """Put the waiting loads into their days; how many loads they were.

    One merge runs at a time: another one is an error while the file ``merging`` is there. A merge that died
    leaves it behind; delete it then. Readers of a day that is just being replaced may have to read again.
    """
    store = Store(spark, table.path)
    parts = whole_parts(spark, table)
    if not parts:
        return 0
    if not store.create_new(table.lock):
        raise RuntimeError(f"another merge runs, or has died: {table.lock}")
    try:
        # Listed again under the lock: the merge before may have taken some.
        parts = whole_parts(spark, table)
        if parts:
            waiting = _waiting(spark, table, parts)
            rows = _with_waiting(_merged(spark, table), waiting, table, _days_of(waiting))
            # Large days are written by many tasks, small ones by one.
            sized = rows.hint("rebalance", DAY).sortWithinPartitions(DAY, *table.key)
            sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(table.days)
            for n in parts:
                store.delete(f"{table.arrivals}/{PART}={n}", recursive=True)
    finally:
        store.delete(table.lock)
    return len(parts)
