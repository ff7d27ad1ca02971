"""Previous value in time order, without sorting a whole series in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import floor_div

# Time units per stretch. The lag inside a stretch is an ordinary window; the last value of
# each stretch is carried to the next one by the same method one level up. With seconds, one
# level leaves 316 tails a year.
STRETCH = 100_000
LEVELS = 1


def _previous(
    df: DataFrame, value: Column, time: str, keys: Sequence[str], stretch: int, levels: int
) -> DataFrame:
    """Add ``_prev``: struct of the previous row's value, null for the first row of a series."""
    boxed = F.struct(value.alias("value"))
    # Rows of one time, which a series should not have, go by their value.
    order = [F.col(time).asc_nulls_last(), value.asc_nulls_first()]
    if levels == 0:
        # With no key this is one task, over the tails of the top level only: their number is
        # the time span divided by stretch**levels, whatever the number of rows.
        return df.withColumn("_prev", F.lag(boxed).over(Window.partitionBy(*keys).orderBy(*order)))

    part = f"_stretch_{levels}"
    group = [*keys, part]
    split = df.withColumn(part, floor_div(F.col(time), stretch))
    inside = split.withColumn("_within", F.lag(boxed).over(Window.partitionBy(*group).orderBy(*order)))
    tails = split.groupBy(*group).agg(F.max_by(boxed, F.when(F.col(time).isNotNull(), F.struct(time, value))).alias("_tail"))
    carried = _previous(tails, F.col("_tail.value"), part, keys, stretch, levels - 1).select(
        *[F.col(g).alias(f"_of_{g}") for g in group], F.col("_prev").alias("_carried")
    )
    # Keys and times may be null, and rows without one are kept.
    same = [inside[g].eqNullSafe(carried[f"_of_{g}"]) for g in group]
    return (
        inside.join(carried, same)
        .withColumn("_prev", F.coalesce("_within", "_carried"))
        .drop(part, "_within", "_carried", *[f"_of_{g}" for g in group])
    )


def with_lag(
    series: DataFrame,
    value: str,
    seed: float,
    *,
    time: str = "t",
    keys: Sequence[str] = (),
    alias: str | None = None,
    stretch: int = STRETCH,
    levels: int = LEVELS,
) -> DataFrame:
    """Add the value of the row before, ``seed`` for the first row of each series.

    ``series`` holds one row per ``(keys, time)``, as a binned series does; a stretch then has
    at most ``stretch`` rows, so no task sorts more than that. The series is read once per level
    and once more: hand in a stored table, not the aggregation that makes it. A row without a time
    comes after all others of its series. Rows of one time follow each other by value.
    """
    kept = series.columns
    previous = _previous(series, F.col(value), time, keys, stretch, levels)
    lagged = F.when(F.col("_prev").isNull(), F.lit(seed)).otherwise(F.col("_prev.value"))
    return previous.select(*kept, lagged.alias(alias or f"{value}_lag1"))
