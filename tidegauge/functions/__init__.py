"""Column expressions."""

from tidegauge.functions.signal import drift_factor, expected_rate, expected_target
from tidegauge.functions.sums import exact_sum
from tidegauge.functions.text import words
from tidegauge.functions.times import (
    epoch_units,
    floor_div,
    from_epoch_units,
    hour_of_day,
    iso_text,
    parse_iso,
)

__all__ = [
    "drift_factor",
    "epoch_units",
    "exact_sum",
    "expected_rate",
    "expected_target",
    "floor_div",
    "from_epoch_units",
    "hour_of_day",
    "iso_text",
    "parse_iso",
    "words",
]
