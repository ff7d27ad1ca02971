"""JSON-lines scans with a fixed or an inferred schema."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
DEFAULT_GLOB = "*.json"


class JsonScan(NamedTuple):
    """Rows that fit the schema, and the lines that do not (fields as far as they parsed).

    ``lines`` are both together, the bad ones marked by ``_corrupt_record``: for one pass over the input.
    """

    rows: DataFrame
    rejects: DataFrame
    lines: DataFrame


def split_rejects(raw: DataFrame) -> JsonScan:
    """Separate the malformed lines of a scan whose schema ends with ``_corrupt_record``.

    Whether a line is malformed depends on the fields that are parsed, and Spark parses only
    the columns a query needs. Both filters therefore refer to every declared field: a line is
    good or bad whichever columns are used later, and a bare count works too.
    """
    fields = [f for f in raw.columns if f != CORRUPT]
    all_parsed = F.size(F.array(*[F.col(f).isNull() for f in fields])) == len(fields)
    corrupt = F.col(CORRUPT)
    return JsonScan(
        raw.filter(corrupt.isNull() & all_parsed).drop(CORRUPT),
        raw.filter(corrupt.isNotNull() & all_parsed),
        raw.filter(all_parsed),
    )


def reject_rows(lines: DataFrame, bad: Column) -> DataFrame:
    """Marked lines of which well-formed ones are marked too where ``bad`` holds, with their record as text."""
    fields = [c for c in lines.columns if c != CORRUPT]
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return lines.withColumn(CORRUPT, F.when(F.col(CORRUPT).isNull() & bad, record).otherwise(F.col(CORRUPT)))


def rejected_lines(rejects: DataFrame) -> DataFrame:
    """Rejects as a text table of the lines themselves."""
    return rejects.select(F.col(CORRUPT).alias("value"))


def with_corrupt(schema: str) -> str:
    return f"{schema}, {CORRUPT} STRING"


def scan_json_lines(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    glob: str = DEFAULT_GLOB,
    modified_after: str | None = None,
) -> JsonScan:
    """JSON lines below ``path``; an absent path gives empty frames of the same schema.

    ``modified_after`` (``YYYY-MM-DDTHH:mm:ss``) leaves out older files when they are listed.
    """
    reader = (
        spark.read.schema(with_corrupt(schema))
        .option("pathGlobFilter", glob)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    try:
        raw = reader.json(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], with_corrupt(schema))
    return split_rejects(raw)


def scan_present(spark: SparkSession, paths: Iterable[str], schema: str, **options) -> JsonScan:
    """Bag union of the inputs that exist, matched by column name."""
    scans = [scan_json_lines(spark, path, schema, **options) for path in paths]
    return JsonScan(
        reduce(DataFrame.unionByName, [s.rows for s in scans]),
        reduce(DataFrame.unionByName, [s.rejects for s in scans]),
        reduce(DataFrame.unionByName, [s.lines for s in scans]),
    )


def scan_inferred(spark: SparkSession, path: str, *, glob: str = DEFAULT_GLOB) -> DataFrame:
    """Schema from the data. One bad value turns a numeric column into text."""
    return spark.read.option("pathGlobFilter", glob).json(path)


def parse_json(text: str | Column, schema: str) -> Column:
    """JSON text in a column to a struct."""
    return F.from_json(text, schema)
