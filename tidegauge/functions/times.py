"""Time keys over TIMESTAMP_NTZ, so that no result depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"

_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def epoch_units(ts: str, unit: str = "SECOND") -> Column:
    """Whole units elapsed since 1970-01-01, rounded down (before 1970 too)."""
    column = F.col(ts)
    clock = F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    # unix_timestamp is the fast way, but it cuts a fraction off towards 1970.
    seconds = F.when(column >= F.expr(_EPOCH), F.unix_timestamp(column)).otherwise(
        F.unix_date(column.cast("date")).cast("bigint") * 86400 + clock
    )
    return seconds if unit == "SECOND" else F.floor(seconds / _SECONDS[unit])


def floor_div(number: Column, by: int) -> Column:
    """Integer division rounded down, exact over the whole range of BIGINT."""
    divisor = F.lit(by).cast("bigint")
    return F.call_function("div", number, divisor) - F.when(number % divisor < 0, 1).otherwise(0)


def from_epoch_units(units: str, unit: str = "SECOND") -> Column:
    return F.expr(f"timestampadd({unit}, {units}, {_EPOCH})")


def hour_of_day(ts: str | Column) -> Column:
    return F.hour(ts)


def iso_text(ts: str | Column) -> Column:
    # The column must be TIMESTAMP_NTZ: the text then shows the same wall clock everywhere.
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_iso(text: str | Column) -> Column:
    """ISO text, with or without a fraction, to TIMESTAMP_NTZ; null where it is not one."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp_ntz")
