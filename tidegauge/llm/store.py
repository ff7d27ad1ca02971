"""Tables that an operator writes and reads again, and small facts that are sent to every task."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.scratch import fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that Spark hands to Python at once, so that long texts don't add up in a worker.
BATCH_ROWS = 200


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the workers, once an application: they import the functions that run there."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        # The driver serves this file to executors for as long as it runs.
        folder = os.path.realpath(tempfile.mkdtemp(prefix="tidegauge-code-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        root = Path(__file__).resolve().parents[2]
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/tidegauge", "zip", root, "tidegauge"))
        _shipped.add(app)


def bounded(df: DataFrame) -> DataFrame:
    """The same frame, in a session whose workers have this package and get few enough rows at once for long texts."""
    ship_code(df.sparkSession)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, BATCH_ROWS)
    return df


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts the lineage, outlives lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of an id filter: 8 MB whatever the number of ids. Fuller filters let more rows through to the join.
FILTER_BITS = 1 << 26


def _filter_places(ids: np.ndarray) -> list[np.ndarray]:
    from tidegauge.llm.kernel import mix

    one = mix(ids.astype(np.int64).view(np.uint64))
    return [(one >> np.uint64(s)) & np.uint64(FILTER_BITS - 1) for s in (0, 26)]


def id_filter(ids: DataFrame):
    """A broadcast Bloom filter over one column of long ids.

    It only spares rows the way to a join that is done in full afterwards, so it may let rows
    through but never loses one. Parts of the filter are united in Spark by position.
    """
    column = ids.columns[0]

    def parts(batches):
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            for places in _filter_places(batch.column(0).drop_null().to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(bits, (places >> np.uint64(3)).astype(np.int64), (1 << (places & np.uint64(7))).astype(np.uint8))
        used = np.flatnonzero(bits.view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bits.view(np.uint64)[used].view(np.int64))], ["place", "bits"])

    rows = ids.select(F.col(column).cast("long")).mapInArrow(parts, "place long, bits long")
    rows = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows["place"].to_numpy()] = rows["bits"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(bits.view(np.uint8))


def maybe_in(shared, ids: pa.Array) -> np.ndarray:
    """Which ids may be in the filter."""
    bits = shared.value
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    found = np.ones(len(values), bool)
    for places in _filter_places(values):
        found &= (bits[(places >> np.uint64(3)).astype(np.int64)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found & np.asarray(ids.is_valid())
