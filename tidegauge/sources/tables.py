"""Parquet tables, literal rows and generated integers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def integers(spark: SparkSession, n: int) -> DataFrame:
    """0 … n-1 in a column ``id``, generated on the executors."""
    return spark.range(n)


def newest(table: DataFrame, columns: Sequence[str], by: Sequence[Column | str], n: int) -> DataFrame:
    """The ``n`` newest rows; ``by`` should be a total order, or ties are resolved arbitrarily."""
    keys = [F.col(k).desc() if isinstance(k, str) else k for k in by]
    return table.orderBy(*keys).limit(n).select(*columns)
