"""Writers. Every one is a distributed write; no rows pass through the driver."""

from tidegauge.sinks.tables import (
    append_sorted,
    create_absent,
    stamped,
    truncate,
    write_lines,
    write_part,
    write_snapshot,
    write_with_fallback,
)
from tidegauge.sinks.warehouse import WarehouseTable

__all__ = [
    "WarehouseTable",
    "append_sorted",
    "create_absent",
    "stamped",
    "truncate",
    "write_lines",
    "write_part",
    "write_snapshot",
    "write_with_fallback",
]
