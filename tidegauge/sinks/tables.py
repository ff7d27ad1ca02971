"""Parquet tables as directories."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidegauge.files import Store

PART = "part"


def stamped(df: DataFrame, at: Column | datetime.datetime | None = None, column: str = "processed_at") -> DataFrame:
    """Add the load time: ``at``, or the time the query runs."""
    stamp = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    return df.withColumn(column, stamp)


def write_snapshot(df: DataFrame, path: str) -> str:
    """Replace the table at ``path``. Not for a table that ``df`` itself reads."""
    df.write.mode("overwrite").parquet(path)
    return path


def truncate(spark: SparkSession, path: str, schema: str) -> str:
    """Make ``path`` an existing table of that schema without rows."""
    return write_snapshot(spark.createDataFrame([], schema), path)


def create_absent(spark: SparkSession, path: str, schema: str) -> str:
    """Make ``path`` a table without rows unless something is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return path


def write_with_fallback(df: DataFrame, paths: Sequence[str]) -> str:
    """Write to the first path that accepts the table; return that path."""
    *earlier, last = paths
    for path in earlier:
        try:
            return write_snapshot(df, path)
        except (PySparkException, Py4JJavaError):
            continue
    return write_snapshot(df, last)


def append_sorted(df: DataFrame, path: str, by: Sequence[str]) -> str:
    """Append to the table, creating it if absent; each file is sorted, so that row groups skip."""
    df.sortWithinPartitions(*by).write.mode("append").parquet(path)
    return path


# Spark's scans skip what begins with an underscore.
_WRITING = "_writing"


def _put_part(writer: DataFrameWriter, spark: SparkSession, path: str, part: int) -> str:
    """Write a numbered part aside, and put it in place when all of it is there.

    Whoever reads sees all files of a part or none, and the one before until the new one is whole. A write that breaks
    off leaves the table as it was; what it wrote aside is never read.
    """
    store, place, aside = Store(spark, path), f"{path}/{PART}={part}", f"{path}/{_WRITING}/{uuid.uuid4().hex}"
    writer.save(f"{aside}/new")
    if store.exists(place):
        store.rename(place, f"{aside}/old")
    store.rename(f"{aside}/new", place)
    store.delete(aside, recursive=True)
    return path


def write_lines(lines: DataFrame, path: str, part: int) -> str:
    """Write one numbered part of a text table; writing it again replaces that part only."""
    return _put_part(lines.write.format("text").option("lineSep", "\n"), lines.sparkSession, path, part)


def write_part(df: DataFrame, path: str, part: int, sort_by: Sequence[str] = ()) -> str:
    """Write one numbered part of the table; writing it again replaces that part only.

    A retried micro-batch therefore leaves the table as a single run would.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return _put_part(df.write.format("parquet"), df.sparkSession, path, part)
