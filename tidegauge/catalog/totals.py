"""Totals, averages, bounds and the trend of stored totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import SALES_SQL, SCALE, sales, table
from tidegauge.functions import epoch_units, exact_sum, from_epoch_units
from tidegauge.operators.aggregates import average, bounds, grand_total, totals
from tidegauge.operators.trend import newest_totals
from tidegauge.plans.sales import STATS_ORDER, sales_trend, store_trend
from tidegauge.scratch import fresh_folder
from tidegauge.sinks import append_sorted, stamped, write_snapshot
from tidegauge.sources import scan_table


def sales_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(sales(spark, sf_dir), scale=SCALE)


def sales_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts")).scalar()
    return stamped(totals(sales(spark, sf_dir), scale=SCALE), newest)


def value_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return average(table(spark, sf_dir, "events"), "value").select(F.round("average", 6).alias("average"))


def value_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grand_total(table(spark, sf_dir, "events"), "value", scale=SCALE)


def time_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds(table(spark, sf_dir, "events").select(epoch_units("ts", "HOUR").alias("t")), "t")


def doubled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.col("event_id") * 2).alias("doubled"))


def range_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.sum("event_id").alias("total"))


def _stats_table(spark: SparkSession, sf_dir: str) -> str:
    """Stored totals of many loads, one load per day: two appends to one table."""
    daily = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("item"), epoch_units("ts", "DAY").alias("day"))
        .agg(exact_sum("value", SCALE).alias("total_amount"))
        .select("item", "total_amount", from_epoch_units("day", "DAY").alias("processed_at"))
    )
    daily = scan_table(spark, write_snapshot(daily, fresh_folder(spark, "daily")))
    path = fresh_folder(spark, "sales-stats")
    early = F.dayofmonth("processed_at") <= 15
    for part in (daily.filter(early), daily.filter(~early)):
        append_sorted(part, path, STATS_ORDER)
    return path


def stats_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, _stats_table(spark, sf_dir))


def newest_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = newest_totals(scan_table(spark, _stats_table(spark, sf_dir)), STATS_ORDER)
    return points.select("index", F.col("amount").cast("double").alias("amount"))


def _rounded(model: DataFrame) -> DataFrame:
    return model.select(F.round("coeff", 6).alias("coeff"), F.round("intercept", 4).alias("intercept"))


def trend_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sales_trend(scan_table(spark, _stats_table(spark, sf_dir))))


def model_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = scan_table(spark, _stats_table(spark, sf_dir))
    return _rounded(scan_table(spark, store_trend(stats, fresh_folder(spark, "model-results"))))


QUERIES = {
    "sales_totals": sales_totals,
    "sales_stats": sales_stats,
    "value_average": value_average,
    "value_total": value_total,
    "time_bounds": time_bounds,
    "doubled_ids": doubled_ids,
    "range_total": range_total,
    "stats_history": stats_history,
    "newest_totals": newest_totals_query,
    "trend_line": trend_line,
    "model_results": model_results,
}

TOTALS_SQL = f"""WITH {SALES_SQL}
SELECT item, CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount FROM sales GROUP BY item"""

_STATS_SQL = """stats AS (
    SELECT event_type AS item,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount,
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS processed_at
    FROM events GROUP BY 1, 3
)"""

_POINTS_SQL = f"""{_STATS_SQL},
points AS (
    SELECT row_number() OVER (ORDER BY processed_at DESC, item DESC) - 1 AS "index",
           CAST(CAST(total_amount AS FLOAT) AS DOUBLE) AS amount
    FROM stats ORDER BY processed_at DESC, item DESC LIMIT 100
)"""

_TREND_SQL = f"""WITH {_POINTS_SQL}
SELECT round(regr_slope(amount, "index"), 6) AS coeff, round(regr_intercept(amount, "index"), 4) AS intercept
FROM points HAVING count(*) >= 2"""

ORACLES = {
    "sales_totals": TOTALS_SQL,
    "sales_stats": """SELECT event_type AS item,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount,
       (SELECT max(ts) FROM events) AS processed_at
FROM events GROUP BY event_type""",
    "value_average": "SELECT round(avg(value), 6) AS average FROM events",
    "value_total": "SELECT CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount FROM events",
    "time_bounds": """SELECT min(t) AS lowest, max(t) AS highest, count(*) AS n_rows
FROM (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t FROM events) HAVING count(*) > 0""",
    "doubled_ids": "SELECT 2 * event_id AS doubled FROM events",
    "range_total": "SELECT CAST(sum(event_id) AS BIGINT) AS total FROM events",
    "stats_history": f"WITH {_STATS_SQL} SELECT item, total_amount, processed_at FROM stats",
    "newest_totals": f'WITH {_POINTS_SQL} SELECT "index", amount FROM points',
    "trend_line": _TREND_SQL,
    "model_results": _TREND_SQL,
}
