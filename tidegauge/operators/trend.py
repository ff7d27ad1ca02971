"""Straight line through the newest totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.constants import TREND_MIN_ROWS, TREND_ROWS
from tidegauge.sources import newest


def newest_totals(stats: DataFrame, by: Sequence[str], n: int = TREND_ROWS) -> DataFrame:
    """The ``n`` newest totals, ``index`` 0 being the newest, ``amount`` narrowed to FLOAT.

    The window numbers at most ``n`` rows, the output of a distributed top-n.
    """
    order = [F.col(k).desc() for k in by]
    top = newest(stats, stats.columns, by, n)
    return top.select(
        (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("index"),
        F.col("total_amount").cast("float").alias("amount"),
    )


def trend_line(points: DataFrame, x: str = "index", y: str = "amount", min_rows: int = TREND_MIN_ROWS) -> DataFrame:
    """Least-squares ``coeff`` and ``intercept``; no row when there are too few points."""
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    return (
        points.agg(
            F.regr_slope(yd, xd).alias("coeff"),
            F.regr_intercept(yd, xd).alias("intercept"),
            F.count(yd).alias("n"),
        )
        .filter(F.col("n") >= min_rows)
        .select("coeff", "intercept")
    )
