"""How a streaming query is started."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_SHUFFLE = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Start a stateful query with ``n`` state partitions.

    The number is fixed by the query's first batch for as long as its checkpoint lives, so it
    has to suit the state and not whatever the session happens to use. A query copies the
    session's settings when it starts; they are put back right after.
    """
    before = spark.conf.get(_SHUFFLE)
    if n is not None:
        spark.conf.set(_SHUFFLE, n)
    try:
        yield
    finally:
        spark.conf.set(_SHUFFLE, before)


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start with a checkpoint; without ``every`` the query stops after the files now present."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
