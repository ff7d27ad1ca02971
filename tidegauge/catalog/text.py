"""Word counts of the documents' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import FILES, FILES_PER_BATCH, arriving, table
from tidegauge.operators.words import lines_of, word_counts
from tidegauge.scratch import fresh_folder
from tidegauge.streaming import read_counts, repartitioned_word_count, running_word_count, stored_counts


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_counts(lines_of(table(spark, sf_dir, "documents"), "text"))


def _line_files(spark: SparkSession, sf_dir: str) -> str:
    """Text files of all documents' lines."""
    texts = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("text").alias("value"))
    source = fresh_folder(spark, "lines")
    arriving(texts).write.option("lineSep", "\n").text(source)
    return source


def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, kept by a stream over text files that arrive in a few batches."""
    source, counts = _line_files(spark, sf_dir), fresh_folder(spark, "word-count")
    running_word_count(
        spark,
        source,
        counts,
        fresh_folder(spark, "checkpoint"),
        max_files=FILES_PER_BATCH,
    ).awaitTermination()
    return read_counts(spark, counts)


def _repartitioned(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Table and checkpoint of a count that read half of the files with 2 partitions of state and goes on with 8."""
    source, first, counts = _line_files(spark, sf_dir), fresh_folder(spark, "word-count"), fresh_folder(spark, "word-count")
    old, new = fresh_folder(spark, "checkpoint"), fresh_folder(spark, "checkpoint")
    half = f"{source}/part-0000[0-{FILES // 2 - 1}]*"
    running_word_count(spark, half, first, old, max_files=FILES_PER_BATCH, partitions=2).awaitTermination()
    repartitioned_word_count(spark, source, counts, new, old, max_files=FILES_PER_BATCH, partitions=8).awaitTermination()
    return counts, new


def word_count_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, by a stream whose state is dealt out anew on the way."""
    return read_counts(spark, _repartitioned(spark, sf_dir)[0])


def word_count_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts, from the state itself."""
    return stored_counts(spark, _repartitioned(spark, sf_dir)[1])


QUERIES = {
    "word_count": word_count,
    "word_count_stream": word_count_stream,
    "word_count_repartitioned": word_count_repartitioned,
    "word_count_state": word_count_state,
}

_WORDS_SQL = """SELECT word, count(*) AS "count" FROM (
    SELECT unnest(string_split(line, ' ')) AS word FROM (
        SELECT unnest(string_split(text, chr(10))) AS line FROM documents
    )
) GROUP BY word"""

ORACLES = dict.fromkeys(QUERIES, _WORDS_SQL)
