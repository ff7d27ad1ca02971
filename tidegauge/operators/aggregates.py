"""Totals, averages and bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import exact_sum


def totals(df: DataFrame, key: str = "item", amount: str = "amount", *, scale: int | None = None) -> DataFrame:
    """``total_amount`` per key. Partial sums keep a hot key from reaching one task as rows."""
    return df.groupBy(key).agg(exact_sum(amount, scale).alias("total_amount"))


def grand_total(df: DataFrame, amount: str = "amount", *, scale: int | None = None) -> DataFrame:
    return df.agg(exact_sum(amount, scale).alias("total_amount"))


def average(df: DataFrame, column: str) -> DataFrame:
    return df.agg({column: "avg"}).toDF("average")


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value and the row count; no row when the input has none."""
    return df.agg(
        F.min(column).alias("lowest"), F.max(column).alias("highest"), F.count(F.lit(1)).alias("n_rows")
    ).filter("n_rows > 0")
