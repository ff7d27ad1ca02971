"""The deterministic part of the request-log model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegauge import constants as c


def drift_factor(t: str = "t") -> Column:
    return F.sin(2 * F.pi() * F.col(t) / c.DRIFT_PERIOD)


def expected_rate(hour: str = "hour") -> Column:
    """Mean number of requests by hour of day: a daily wave with a floor."""
    wave = F.sin(2 * F.pi() * F.col(hour) / c.HOURS_PER_DAY)
    return F.greatest(c.RATE_BASE + c.RATE_SWING * wave, F.lit(float(c.RATE_FLOOR)))


def expected_target(
    y_lag1: str = "y_lag1", drift: str = "drift_factor", requests: str = "requests", size: str = "size"
) -> Column:
    """Mean of the target given its lag, the drift, the load and the size."""
    load = F.pow(F.col(requests).cast("double"), F.lit(c.TARGET_POWER))
    return (
        c.TARGET_LAG * F.col(y_lag1)
        + (c.TARGET_LOAD + c.TARGET_DRIFT * F.col(drift)) * load
        + c.TARGET_SIZE * F.col(size)
    )
