"""Previous value of a series on a stream, with state for each series between batches and runs.

A series' state is its last row, and those that wait for an earlier one. Binned series have one
row a time unit, so what a task holds of a series is bounded by the time that a batch spans, whatever
the number of events behind the bins. State lives in RocksDB, next to the executors and in the checkpoint.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidegauge.sinks import write_part
from tidegauge.streaming.runs import start, state_partitions

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: How a row stands to its series: follows the row before it, comes behind rows that went on without it, has no time.
IN_ORDER, LATE, UNTIMED = "in order", "late", "no time"
PLACE = "place"
_KEY, _LAG = "_series", "_lag"


# The processor runs in workers, on the driver's side too, that need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LagProcessor(StatefulProcessor):
    """Rows of a series in time order, each with the value before it.

    A row goes on once one is seen that is ``delay`` time units younger; until then it waits, and rows
    before it may still come. Rows no younger than the last that went on are late.
    """

    def __init__(self, fields: StructType, columns: Sequence[str], value: str, time: str, seed: float, delay: int):
        self.columns, self.at, self.own = list(columns), columns.index(time), columns.index(value)
        self.row = StructType([fields[c] for c in columns])
        self.kept = StructType([StructField("t", fields[time].dataType), StructField("value", fields[value].dataType)])
        self.out = Row(*columns, _LAG, PLACE)
        self.seed, self.delay = seed, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.kept)
        self.waiting = handle.getListState("waiting", self.row)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = self.last.get() if self.last.exists() else None
        new = []
        for row in rows:
            row = tuple(row[c] for c in self.columns)
            if row[self.at] is None:
                yield self.out(*row, None, UNTIMED)
            elif last is not None and row[self.at] <= last[0]:
                yield self.out(*row, None, LATE)
            else:
                new.append(row)
        if not new:
            return
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        # Among rows of one time the smallest goes on, so that the result does not depend on their order.
        new = sorted((*held, *new), key=lambda row: (row[self.at], [(x is not None, x) if x is not None else (False,) for x in row]))
        youngest = new[-1][self.at]
        ready = [row for row in new if row[self.at] <= youngest - self.delay]
        if len(ready) < len(new):
            self.waiting.put(new[len(ready) :])
        elif held:
            self.waiting.clear()
        for row in ready:
            if last is not None and row[self.at] == last[0]:
                yield self.out(*row, None, LATE)
                continue
            yield self.out(*row, self.seed if last is None else last[1], IN_ORDER)
            last = (row[self.at], row[self.own])
        if ready:
            self.last.update(tuple(last))

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Start a query whose state is kept by RocksDB in so many partitions; a query copies the settings when it starts."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        with state_partitions(spark, partitions):
            yield
    finally:
        spark.conf.set(_PROVIDER, before)


def lagged(
    rows: DataFrame, value: str, seed: float, *, time: str = "t", keys: Sequence[str] = (), alias: str | None = None, delay: int = 0
) -> DataFrame:
    """A stream's rows with the value of the row before in their series, and their ``place``.

    The first row of a series gets ``seed``. With rows that arrive at most ``delay`` time units behind the youngest of their
    series, the lags are those that `operators.lag.with_lag` gives to the whole table. Later ones are handed on as
    ``late`` and rows without a time as ``no time``, both without a lag, and change no other row's. Rows younger than the
    youngest less ``delay`` wait for the next batch that has rows of their series. Keys may be null.
    """
    columns = rows.columns
    kinds = {f.name: f.dataType for f in rows.schema}
    out = StructType([*rows.schema.fields, StructField(_LAG, kinds[value]), StructField(PLACE, StringType())])
    series = F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))) if keys else F.lit(0)
    grouped = rows.withColumn(_KEY, F.to_json(series) if keys else F.lit("")).groupBy(_KEY)
    processor = LagProcessor(rows.schema, columns, value, time, seed, delay)
    found = grouped.transformWithState(processor, out, "Append", "None")
    return found.withColumnRenamed(_LAG, alias or f"{value}_lag1")


def stream_lagged(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    value: str,
    seed: float,
    *,
    time: str = "t",
    keys: Sequence[str] = (),
    delay: int = 0,
    partitions: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Append the rows with their lags, one numbered part a batch. A run continues where the last one ended."""
    found = lagged(rows, value, seed, time=time, keys=keys, delay=delay)
    with rocksdb(rows.sparkSession, partitions):
        return start(found.writeStream.foreachBatch(lambda batch, number: write_part(batch, table, number, [time]) and None), checkpoint, every)


def stored_lags(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The last row's time and value of every series, read from the state itself: ``series`` (JSON of its keys), ``t``, ``value``."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "last").load()
    return state.select(F.col("key").getField(_KEY).alias("series"), "value.t", "value.value")
