"""Drop what has outlived its retention."""

from __future__ import annotations

import datetime
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidegauge.constants import RETENTION_MINUTES
from tidegauge.files import Store, list_files, milliseconds, paths_of
from tidegauge.functions import floor_div

# Deletions under way at once; each is a call to the file system and no more.
DELETES = 16


def retained(
    df: DataFrame, ts: str = "ts", *, now: datetime.datetime | None = None, minutes: int = RETENTION_MINUTES
) -> DataFrame:
    """Rows whose age in whole minutes is at most ``minutes``.

    Age counts from ``now``, by default from the newest row, which is then looked up at once. The
    bound is a literal, so it reaches a Parquet scan.
    """
    if now is None:
        now = df.agg(F.max(ts)).first()[0]
    if now is None:
        return df
    oldest = _oldest(now, minutes)
    if df.schema[ts].dataType == TimestampNTZType():
        # As text: a plain literal would be an instant, and shift with the session time zone.
        bound = F.lit(oldest.isoformat(" ")).cast("timestamp_ntz")
    else:
        bound = F.lit(oldest)
    return df.filter(F.col(ts) > bound)


def file_ages(files: DataFrame, now: datetime.datetime, minutes: int = RETENTION_MINUTES) -> DataFrame:
    """Listed files with their ``age`` in whole minutes, and whether they have ``expired``.

    A file as young as ``minutes`` is kept, one from the future too.
    """
    age = floor_div(F.lit(milliseconds(now)).cast("bigint") - F.unix_millis("modified"), 60_000)
    return files.withColumn("age", age).withColumn("expired", F.col("age") > minutes)


def purge(
    spark: SparkSession,
    source: str,
    now: datetime.datetime | None = None,
    minutes: int = RETENTION_MINUTES,
    *,
    glob: str = "*.json",
    parallelism: int = DELETES,
) -> int:
    """Delete the files below ``source`` that have outlived ``minutes``; how many they were.

    Files go whole, by their modification time; none is read or copied. Times are compared as instants. A
    file that has been written again, or has gone, since the listing is left alone, so purges may overlap each other and
    loads. What breaks off is made up for by the next purge. Without ``now`` ages count from the present.
    """
    now = now or datetime.datetime.now(datetime.UTC)
    store = Store(spark, source)
    expired = file_ages(list_files(spark, source, glob), now, minutes).filter("expired")

    def gone(file: tuple[str, int]) -> bool:
        path, listed = file
        return store.modified(path) == listed and store.delete(path)

    with ThreadPool(parallelism) as pool:
        return sum(pool.imap_unordered(inheritable_thread_target(spark)(gone), paths_of(expired)))


def _oldest(now: datetime.datetime, minutes: int) -> datetime.datetime:
    # Age in whole minutes <= n is the same as age < n + 1 minutes.
    return now - datetime.timedelta(minutes=minutes + 1)


def retained_since(now: datetime.datetime, minutes: int = RETENTION_MINUTES) -> str:
    """Bound for ``modified_after``: files with a later modification time are kept."""
    return _oldest(now, minutes).strftime("%Y-%m-%dT%H:%M:%S")
