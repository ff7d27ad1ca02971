"""Sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(column: str, scale: int | None = None) -> Column:
    """``sum`` of a DOUBLE column.

    A floating-point sum changes in its last digits with the order in which partitions arrive.
    Where the values are known to have at most ``scale`` decimals, whole numbers of the last
    decimal are summed instead, which is the same on every run and as fast (decimals are not).
    A value with more decimals is an error. Past the range of BIGINT it raises, as Spark's own sum
    of integers does.
    """
    if scale is None:
        return F.sum(column)
    units = F.col(column) * 10**scale
    finer = F.abs(units - F.rint(units)) > 1e-4
    wrong = F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), F.col(column).cast("string"))).cast("bigint")
    return F.sum(F.when(finer, wrong).otherwise(F.rint(units).cast("bigint"))) / 10**scale
