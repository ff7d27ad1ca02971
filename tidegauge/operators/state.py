"""One value per key, carried from run to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.latest import absent_from
from tidegauge.schemas import METADATA


def latest_state(
    updates: DataFrame, *, key: str = "key", value: str = "value", at: str = "updated_at", tie: str | None = None
) -> DataFrame:
    """Newest value of each key. ``tie`` decides between updates of the same instant."""
    order = F.col(at) if tie is None else F.struct(at, tie)
    return updates.groupBy(F.col(key).alias("key")).agg(
        F.max_by(F.col(value), order).alias("value"), F.max(at).alias("updated_at")
    )


def seeded(state: DataFrame, seeds: Sequence[tuple]) -> DataFrame:
    """State plus those literal ``(key, value, updated_at)`` seeds whose key it does not have.

    ``state`` is a stored table: the seeds' keys are looked up there by a filter that the scan
    evaluates, so the state is neither shuffled nor sent anywhere.
    """
    rows = state.sparkSession.createDataFrame(list(seeds), METADATA)
    taken = state.filter(F.col("key").isin([key for key, *_ in seeds]))
    return state.unionByName(absent_from(rows, taken, ["key"]))
