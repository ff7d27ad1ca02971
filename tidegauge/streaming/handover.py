"""A running word count that goes on with another number of state partitions.

A checkpoint fixes how many partitions its state has. So the state of the stopped query is read back and
kept as a table, which is the first thing that a new query with a checkpoint of its own reads. From
then on all counts are in the new state, and a batch costs what it would have cost before.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.files import Store
from tidegauge.functions import words
from tidegauge.schemas import WORD_COUNT
from tidegauge.sinks import create_absent, write_part, write_snapshot
from tidegauge.sources import stream_text
from tidegauge.streaming.runs import start, state_partitions

_HANDOVER = "handover"


def stored_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``word`` and ``count`` as the state of a running count holds them after its last finished batch."""
    # The state's field is called after the aggregate's buffer.
    return spark.read.format("statestore").load(checkpoint).select("key.word", "value.*").toDF("word", "count")


def _within_store(path: Column) -> Column:
    """The path without file system and authority, which are not spelled alike everywhere; a source lies in one."""
    return F.regexp_replace(path, "^[^/]*:(//[^/]*)?", "")


def _last_batch(spark: SparkSession, checkpoint: str) -> int:
    store = Store(spark, checkpoint)
    planned, finished = ({int(n) for n in store.names(f"{checkpoint}/{log}") if n.isdigit()} for log in ("offsets", "commits"))
    if not finished:
        raise ValueError(f"{checkpoint} has no finished batch")
    if max(planned) > max(finished):
        raise ValueError(f"{checkpoint} has a batch that broke off: run its query until that is finished, and stop it")
    return max(finished)


def read_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path``, within its file system, of the files that the finished batches of a running count have read, or that it took over as read."""
    # After the settings the log has one line for each source. A source may know files that no batch is planned for yet.
    planned = spark.read.text(f"{checkpoint}/offsets/{_last_batch(spark, checkpoint)}", wholetext=True).first()["value"]
    until = {i: json.loads(line)["logOffset"] for i, line in enumerate(planned.splitlines()[2:]) if line != "-"}
    files = spark.createDataFrame([], "path STRING")
    for i, last in until.items():
        log = spark.read.text(f"{checkpoint}/sources/{i}").select(F.from_json("value", "path STRING, batchId BIGINT").alias("file"))
        files = files.unionByName(log.where(F.col("file.batchId") <= last).select(_within_store(F.col("file.path")).alias("path")))
    earlier = f"{checkpoint}/{_HANDOVER}/files"
    if Store(spark, checkpoint).exists(earlier):
        files = files.unionByName(spark.read.parquet(earlier))
    return files.distinct()


def _hand_over(spark: SparkSession, old: str, place: str) -> tuple[str, str]:
    """Tables of the counts and of the files behind them, made once: a query that starts again finds them."""
    counts, files = f"{place}/counts", f"{place}/files"
    if not Store(spark, place).exists(f"{files}/_SUCCESS"):
        _last_batch(spark, old)
        write_snapshot(stored_counts(spark, old), counts)
        write_snapshot(read_files(spark, old), files)
    return counts, files


def repartitioned_word_count(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    old: str,
    *,
    partitions: int,
    max_files: int | None = None,
    archive: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Go on from the checkpoint ``old`` of a stopped `running_word_count`, with ``partitions`` partitions of state.

    ``table`` is a new one, read with `read_counts`; it holds all counts from the first batch on. Files that the old query
    has read are opened once more and left out; where they have been archived, only those of its last
    batch. ``old`` is not changed, and not needed any more once this query has started. It is an error if it has no finished batch,
    or one that broke off.
    """

    def store(counts: DataFrame, batch_id: int) -> None:
        write_part(counts, table, batch_id)

    create_absent(spark, table, WORD_COUNT)
    kept, files = _hand_over(spark, old, f"{checkpoint}/{_HANDOVER}")
    lines = stream_text(spark, source, max_files=max_files, archive=archive).select("value", _within_store(F.col("_metadata.file_path")).alias("path"))
    unread = lines.join(spark.read.parquet(files), "path", "left_anti")
    fresh = unread.select(F.explode(words("value")).alias("word"), F.lit(1).cast("bigint").alias("count"))
    before = spark.readStream.schema(WORD_COUNT).parquet(kept)
    counts = before.unionByName(fresh).groupBy("word").agg(F.sum("count").alias("count"))
    with state_partitions(spark, partitions):
        return start(counts.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)
