"""Latest row per key, and tables that keep it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.sinks import write_snapshot
from tidegauge.sinks.tables import PART


def latest_rows(df: DataFrame, key: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the greatest ``version`` for each key.

    An aggregate rather than a ranking window: every task reduces its rows to one per key before
    the shuffle, so a key that holds a third of the table is not sorted in one place. Rows that
    agree on key and version are told apart by their remaining columns, so the result does not
    depend on their order.
    """
    rest = [c for c in df.columns if c not in key and c not in version]
    picked = df.groupBy(*key).agg(F.max(F.struct(*version, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in key else F.col("_row")[c].alias(c) for c in df.columns])


def read_parts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All parts of a table with their number; no rows when nothing has been written yet."""
    with_part = f"{schema}, {PART} BIGINT"
    try:
        return spark.read.schema(with_part).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_part)


def read_replacing(
    spark: SparkSession, path: str, schema: str, key: Sequence[str], version: Sequence[str] = ()
) -> DataFrame:
    """A replacing table: the last part wins, within a part the greatest ``version``."""
    return latest_rows(read_parts(spark, path, schema), key, [PART, *version]).drop(PART)


def compact(
    spark: SparkSession,
    path: str,
    target: str,
    schema: str,
    key: Sequence[str],
    version: Sequence[str] = (),
) -> str:
    """Write the merged table as part 0 of a new directory; the parts read stay untouched."""
    write_snapshot(read_replacing(spark, path, schema, key, version), f"{target}/{PART}=0")
    return target


def absent_from(df: DataFrame, stored: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(stored.select(*key), list(key), "left_anti")
