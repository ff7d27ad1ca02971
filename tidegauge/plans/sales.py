"""Sales records to stored totals, and the trend of the newest ones."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from tidegauge.operators.aggregates import totals
from tidegauge.operators.trend import newest_totals, trend_line
from tidegauge.schemas import SALES
from tidegauge.sinks import append_sorted, stamped
from tidegauge.sources import scan_json_lines
from tidegauge.sources.json_lines import rejected_lines

STATS_ORDER = ("processed_at", "item")


def sales_stats(
    sales: DataFrame, processed_at: Column | datetime.datetime | None = None, scale: int | None = None
) -> DataFrame:
    return stamped(totals(sales, scale=scale), processed_at)


def load_sales(
    spark: SparkSession,
    source: str,
    table: str,
    processed_at: Column | datetime.datetime | None = None,
    scale: int | None = None,
    rejects: str | None = None,
) -> bool:
    """Append the totals of the JSON lines below ``source``; False when there is nothing to load.

    Lines that are no sales are appended to the text table ``rejects``.
    """
    scan = scan_json_lines(spark, source, SALES)
    if rejects is not None:
        rejected_lines(scan.rejects).write.mode("append").text(rejects)
    if scan.rows.isEmpty():
        return False
    append_sorted(sales_stats(scan.rows, processed_at, scale), table, STATS_ORDER)
    return True


def sales_trend(stats: DataFrame) -> DataFrame:
    return trend_line(newest_totals(stats, STATS_ORDER))


def store_trend(stats: DataFrame, table: str, updated_at: Column | datetime.datetime | None = None) -> str:
    """Append the trend's coefficients; nothing is added when there are too few totals."""
    return append_sorted(stamped(sales_trend(stats), updated_at, "updated_at"), table, ["updated_at"])
