"""Batch and streaming scans."""

from tidegauge.sources.json_lines import (
    JsonScan,
    parse_json,
    scan_inferred,
    scan_json_lines,
    scan_present,
    split_rejects,
)
from tidegauge.sources.streams import stream_json_lines, stream_text
from tidegauge.sources.tables import empty_table, integers, literal_rows, newest, scan_table
from tidegauge.sources.variants import scan_inferred_fields, scan_variants, split_fields

__all__ = [
    "JsonScan",
    "empty_table",
    "integers",
    "literal_rows",
    "newest",
    "parse_json",
    "scan_inferred",
    "scan_inferred_fields",
    "scan_json_lines",
    "scan_present",
    "scan_table",
    "scan_variants",
    "split_fields",
    "split_rejects",
    "stream_json_lines",
    "stream_text",
]
