"""File streams. A stream reads each file once; its checkpoint remembers which."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegauge.sources.json_lines import CORRUPT, DEFAULT_GLOB, JsonScan, split_rejects, with_corrupt


def _reader(spark: SparkSession, max_files: int | None, archive: str | None):
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        # Finished files move aside. The last batch's files may stay: never take an empty
        # source directory as the sign that a load is complete.
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader


def stream_text(
    spark: SparkSession, path: str, *, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """One row ``value`` per line of the text files below ``path``; lines end at line feeds only."""
    return _reader(spark, max_files, archive).format("text").option("lineSep", "\n").load(path)


def stream_json_lines(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    glob: str = DEFAULT_GLOB,
    max_files: int | None = None,
    archive: str | None = None,
) -> JsonScan:
    raw = (
        _reader(spark, max_files, archive)
        .schema(with_corrupt(schema))
        .option("pathGlobFilter", glob)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return split_rejects(raw)
