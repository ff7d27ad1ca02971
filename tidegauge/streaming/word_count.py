"""Running word count over arriving text files.

The state holds one count per distinct word: it is bounded by the vocabulary, not by the text. A batch
writes the counts that it changed as a numbered part of the table; readers take each word's last one,
and no part that they read is ever replaced by another batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.latest import read_replacing
from tidegauge.operators.words import word_counts
from tidegauge.schemas import WORD_COUNT
from tidegauge.sinks import create_absent, truncate, write_part
from tidegauge.sources import stream_text
from tidegauge.streaming.runs import start, state_partitions


def running_word_count(
    spark: SparkSession,
    source: str,
    table: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    partitions: int | None = None,
    every: str | None = None,
    archive: str | None = None,
    restart: bool = False,
) -> StreamingQuery:
    """Keep the counts so far in ``table``, to be read with `read_counts`.

    A batch that is run again writes the same part. ``restart`` empties the table first; it belongs
    with a new checkpoint. Files that are done with move to ``archive``, where one is named.
    """

    def store(counts: DataFrame, batch_id: int) -> None:
        write_part(counts, table, batch_id)

    prepare = truncate if restart else create_absent
    prepare(spark, table, WORD_COUNT)
    counts = word_counts(stream_text(spark, source, max_files=max_files, archive=archive))
    with state_partitions(spark, partitions):
        return start(counts.writeStream.outputMode("update").foreachBatch(store), checkpoint, every)


def read_counts(spark: SparkSession, table: str) -> DataFrame:
    return read_replacing(spark, table, WORD_COUNT, ["word"])


def console_word_count(
    spark: SparkSession,
    source: str,
    checkpoint: str,
    *,
    sink: str = "console",
    name: str | None = None,
    partitions: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Print the counts after each batch (``sink="memory"`` keeps them as the table ``name``)."""
    writer = word_counts(stream_text(spark, source)).writeStream.outputMode("complete").format(sink)
    if name is not None:
        writer = writer.queryName(name)
    with state_partitions(spark, partitions):
        return start(writer, checkpoint, every)
