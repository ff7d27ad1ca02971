"""JSON and Parquet scans, unions, retention, replacing tables and state."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import (
    LOG_SQL,
    SALES_SQL,
    FILES_PER_BATCH,
    SCALE,
    arriving,
    as_json,
    hourly_series,
    sales,
    table,
)
from tidegauge.catalog.totals import TOTALS_SQL
from tidegauge.constants import LAG_SEED, LAST_VALUE_KEY
from tidegauge.files import Store, list_files, milliseconds, paths_of
from tidegauge.functions import exact_sum, iso_text
from tidegauge.operators.aggregates import grand_total, totals
from tidegauge.operators.daily import DailyTable, add_load, merge_loads, read_daily
from tidegauge.operators.latest import absent_from, latest_rows, read_parts, read_replacing
from tidegauge.operators.retention import purge, retained
from tidegauge.operators.state import latest_state, seeded
from tidegauge.plans.requests import LOG_KEY, STORED, continued_features, load_requests, request_features, stored_log
from tidegauge.schemas import REQUEST_LOGS, SALES, SALES_STATS
from tidegauge.scratch import fresh_folder
from tidegauge.sinks import WarehouseTable, write_snapshot, write_with_fallback
from tidegauge.sources import (
    parse_json,
    scan_inferred,
    scan_inferred_fields,
    scan_json_lines,
    scan_present,
    scan_table,
    stream_json_lines,
)
from tidegauge.sources.json_lines import CORRUPT
from tidegauge.streaming import stream_latest, stream_totals

EVENT = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Buckets of the tables by user.
BUCKETS = 8


def sales_json_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_json(spark, sales(spark, sf_dir), "sales")
    return totals(scan_json_lines(spark, path, SALES).rows, scale=SCALE)


def sales_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines of which those of two items are broken: cut off, and with text as amount."""
    record = F.to_json(F.struct("item", "amount", "ts"))
    line = (
        F.when(F.col("item") == "error", F.substr(record, F.lit(1), F.length(record) - 1))
        .when(F.col("item") == "signup", F.regexp_replace(record, '"amount":', '"amount":"x'))
        .otherwise(record)
    )
    path = fresh_folder(spark, "sales-broken")
    sales(spark, sf_dir).select(line.alias("value")).write.text(path)
    lines = scan_json_lines(spark, path, SALES, glob="*.txt").lines
    item = F.when(F.col(CORRUPT).isNotNull(), "(rejected)").otherwise(F.col("item"))
    return lines.groupBy(item.alias("item")).agg(F.count(F.lit(1)).alias("n_rows"))


def load_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of request-log lines of which some are cut off and some have no time: rows and rejects together."""
    log = request_features(hourly_series(spark, sf_dir)).withColumn("timestamp", iso_text("timestamp"))
    bad_time = log.withColumn("timestamp", F.when(F.col("hour") == 3, "03/02/2024 03:00").otherwise(F.col("timestamp")))
    record = F.to_json(F.struct(*bad_time.columns))
    line = F.when(F.col("hour") == 5, F.substr(record, F.lit(1), F.length(record) - 1)).otherwise(record)
    source, path, rejects = (fresh_folder(spark, label) for label in ("log-broken", "request-logs", "rejects"))
    bad_time.select(line.alias("value")).write.text(source)
    load_requests(spark, source, path, 0, rejects=rejects, glob="*.txt")
    good = read_replacing(spark, path, REQUEST_LOGS, LOG_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = spark.read.text(rejects).agg(F.count(F.lit(1)).alias("n_rows"))
    return good.select(F.lit("loaded").alias("lines"), "n_rows").unionByName(bad.select(F.lit("rejected").alias("lines"), "n_rows"))


def series_in_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request log made in two loads, the second of which takes its first lag from the stored state."""
    hourly = hourly_series(spark, sf_dir)
    middle = hourly.agg(F.expr("percentile_approx(t, 0.5)")).first()[0]
    state = fresh_folder(spark, "metadata")
    log = []
    for part, stretch in enumerate((hourly.filter(F.col("t") < middle), hourly.filter(F.col("t") >= middle))):
        log.append(continued_features(spark, stretch, state, part))
    return log[0].unionByName(log[1]).select("t", "y", "y_lag1")


def fallback_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The totals, whose first place does not take them."""
    places = ["no-such-store://totals", fresh_folder(spark, "fallback")]
    return scan_table(spark, write_with_fallback(totals(sales(spark, sf_dir), scale=SCALE), places))


def json_inferred_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = as_json(spark, sales(spark, sf_dir), "sales")
    return grand_total(scan_inferred(spark, path), scale=SCALE)


def inferred_with_bad_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines of which some amounts are text and some lines are cut off: totals of the good values by item, and rejects."""
    record = F.to_json(F.struct("item", "amount", "ts"))
    line = (
        F.when((F.col("item") == "error") & (F.col("ts") % 2 == 0), F.substr(record, F.lit(1), F.length(record) - 1))
        .when((F.col("item") == "signup") & (F.col("ts") % 3 == 0), F.regexp_replace(record, '"amount":([^,}]+)', '"amount":"about $1"'))
        .otherwise(record)
    )
    path = fresh_folder(spark, "sales-mixed")
    sales(spark, sf_dir).select(line.alias("value")).write.text(path)
    scan = scan_inferred_fields(spark, path, "*.txt")
    good = scan.rows.groupBy("item").agg(F.count(F.lit(1)).alias("n_rows"), exact_sum("amount", SCALE).alias("total_amount"))
    bad = scan.rejects.groupBy(F.concat(F.lit("rejected "), F.coalesce("field", F.lit("lines"))).alias("item")).agg(F.count(F.lit(1)).alias("n_rows"))
    return good.unionByName(bad.withColumn("total_amount", F.lit(None).cast("double")))


def json_column_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select(parse_json("props", "k BIGINT").alias("p"))
    return parsed.agg(F.sum("p.k").alias("total"))


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_table(spark, write_snapshot(sales(spark, sf_dir), fresh_folder(spark, "round-trip")))


def union_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived and newly arrived records, and a place that does not exist."""
    records = sales(spark, sf_dir)
    archived = F.coalesce(F.col("amount") < 50, F.lit(False))
    paths = [
        as_json(spark, records.filter(archived), "archive"),
        as_json(spark, records.filter(~archived), "success"),
        fresh_folder(spark, "absent"),
    ]
    return scan_present(spark, paths, SALES).rows


def retained_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retained(table(spark, sf_dir, "events")).select("event_id", "ts", "value")


def retained_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in one file a day, as old as its last event, after two purges at the newest event: which days are still there.

    The first purge keeps ten days, the second the usual number of minutes.
    """
    day = F.date_trunc("DAY", "ts").cast("date")
    events = table(spark, sf_dir, "events").withColumn("day", day)
    source = fresh_folder(spark, "archive")
    events.repartition("day").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").partitionBy("day").json(source)
    days = events.groupBy(F.col("day").cast("string").alias("day")).agg(F.max("ts").alias("last"), F.count(F.lit(1)).alias("n_rows"))
    # Events without a time are in a folder of their own, whose files count as new.
    last = {row["day"]: row["last"] for row in days.filter("day IS NOT NULL").toLocalIterator()}
    now, store = max(last.values()), Store(spark, source)
    for path, _ in paths_of(list_files(spark, source, "*.json")):
        store.set_modified(path, milliseconds(last.get(path.split("/day=")[1].split("/")[0], now)))
    purge(spark, source, now, 10 * 24 * 60)
    purge(spark, source, now)
    left = list_files(spark, source, "*.json").select(F.regexp_extract("path", "/day=([^/]+)/", 1).alias("day")).distinct()
    kept = left.withColumn("kept", F.lit(True))
    return days.select("day", "n_rows").join(kept, "day", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def request_logs_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rows(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])


def request_log_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the request log. The second repeats eight hours of each day with new targets."""
    log = request_features(hourly_series(spark, sf_dir)).withColumn("timestamp", iso_text("timestamp"))
    first = log.filter("hour < 16").withColumn("y", F.col("y") + 1)
    second = log.filter("hour >= 8")
    path = fresh_folder(spark, "request-logs")
    for part, rows in enumerate((first, second)):
        load_requests(spark, as_json(spark, rows, "request-log"), path, part)
    stored = read_replacing(spark, path, REQUEST_LOGS, LOG_KEY)
    return stored.select(
        *[c for c in STORED if c not in ("hour", "size", "drift_factor")],
        F.col("hour").cast("int").alias("hour"),
        F.round("size", 6).alias("size"),
        F.round("drift_factor", 9).alias("drift_factor"),
    )


def request_log_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads of the request log that overlap: two are merged into their days, the third still waits."""
    hourly = hourly_series(spark, sf_dir)
    newest = hourly.agg(F.max("t")).first()[0]
    log = stored_log(request_features(hourly)).drop("processed_at")
    kind = ", ".join(f"{c} {t}" for c, t in log.dtypes)
    daily = DailyTable(fresh_folder(spark, "request-days"), kind, LOG_KEY, "timestamp")
    loads = ("hour < 16", "hour >= 8", f"hour >= 12 AND t > {newest - 100}")
    for part, rows in enumerate(loads):
        add_load(log.filter(rows).withColumn("y", F.col("y") + part + 1), daily, part)
        if part < 2:
            merge_loads(spark, daily)
    return read_daily(spark, daily).select("timestamp", "t", "requests", "y", F.col("day").cast("string").alias("day"))


def _warehouse(spark: SparkSession, label: str) -> WarehouseTable:
    path = fresh_folder(spark, label)
    return WarehouseTable(f"events_{path[-32:]}", EVENT, path, ["user_id"], BUCKETS)


def warehouse_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record per user of a bucketed table that three loads were appended to: no shuffle."""
    events, kept = table(spark, sf_dir, "events"), _warehouse(spark, "warehouse")
    for load in range(3):
        kept.insert(events.filter(F.col("event_id") % 3 == load))
    return latest_rows(kept.create(spark), kept.key, ["ts", "event_id"])


def warehouse_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of users that never had an error at night, by two bucketed tables: joined without a shuffle."""
    events = table(spark, sf_dir, "events")
    bought, failed = _warehouse(spark, "bought"), _warehouse(spark, "failed")
    bought.insert(events.filter("event_type = 'purchase'"))
    failed.insert(events.filter("event_type = 'error' AND hour(ts) < 2"))
    return absent_from(bought.create(spark), failed.create(spark), bought.key).select("event_id", "user_id", "value")


def _user_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = table(spark, sf_dir, "events").withColumn("key", F.col("user_id").cast("string"))
    return latest_state(updates, at="ts", tie="event_id")


def latest_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_state(spark, sf_dir)


def seeded_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = datetime.datetime(2024, 1, 1)
    stored = write_snapshot(_user_state(spark, sf_dir), fresh_folder(spark, "state"))
    return seeded(scan_table(spark, stored), [(LAST_VALUE_KEY, LAG_SEED, start), ("8", LAG_SEED, start)])


def sales_stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each batch of arriving files, added up."""
    source, path = as_json(spark, arriving(sales(spark, sf_dir)), "sales-arriving"), fresh_folder(spark, "sales-stats")
    new = stream_json_lines(spark, source, SALES, max_files=FILES_PER_BATCH).rows
    stream_totals(new, path, fresh_folder(spark, "checkpoint"), scale=SCALE).awaitTermination()
    return totals(read_parts(spark, path, SALES_STATS), amount="total_amount", scale=SCALE)


def request_log_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest record per user, kept up to date by a stream."""
    source, path = as_json(spark, arriving(table(spark, sf_dir, "events")), "events-arriving"), fresh_folder(spark, "latest")
    new = stream_json_lines(spark, source, EVENT, max_files=FILES_PER_BATCH).rows
    key, version = ["user_id"], ["ts", "event_id"]
    stream_latest(new, path, fresh_folder(spark, "checkpoint"), key, version).awaitTermination()
    # Files arrive in no particular order, so the record's own version decides, not its batch.
    return latest_rows(read_parts(spark, path, EVENT).drop("part"), key, version)


QUERIES = {
    "sales_json_totals": sales_json_totals,
    "sales_json_rejects": sales_json_rejects,
    "load_with_rejects": load_with_rejects,
    "series_in_two_loads": series_in_two_loads,
    "fallback_write": fallback_write,
    "json_inferred_total": json_inferred_total,
    "json_column_total": json_column_total,
    "parquet_round_trip": parquet_round_trip,
    "union_inputs": union_inputs,
    "retained_rows": retained_rows,
    "retained_files": retained_files,
    "request_logs_latest": request_logs_latest,
    "request_log_replaced": request_log_replaced,
    "request_log_daily": request_log_daily,
    "warehouse_latest": warehouse_latest,
    "warehouse_absent": warehouse_absent,
    "inferred_with_bad_values": inferred_with_bad_values,
    "latest_state": latest_state_query,
    "seeded_state": seeded_state,
    "sales_stream_totals": sales_stream_totals,
    "request_log_stream_upsert": request_log_stream_upsert,
}

_LATEST_SQL = """SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1"""

_STATE_SQL = """state AS (
    SELECT CAST(user_id AS VARCHAR) AS key, value, ts AS updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1
)"""

ORACLES = {
    "sales_json_totals": TOTALS_SQL,
    "sales_json_rejects": """SELECT CASE WHEN event_type IN ('error', 'signup') THEN '(rejected)' ELSE event_type END AS item,
       count(*) AS n_rows
FROM events GROUP BY 1""",
    "load_with_rejects": f"""WITH {LOG_SQL}
SELECT CASE WHEN hour IN (3, 5) THEN 'rejected' ELSE 'loaded' END AS lines, count(*) AS n_rows FROM log GROUP BY 1""",
    "series_in_two_loads": f"WITH {LOG_SQL} SELECT t, y, y_lag1 FROM log",
    "fallback_write": TOTALS_SQL,
    "json_inferred_total": "SELECT CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount FROM events",
    "json_column_total": "SELECT CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events",
    "parquet_round_trip": f"WITH {SALES_SQL} SELECT item, amount, ts FROM sales",
    "union_inputs": f"WITH {SALES_SQL} SELECT item, amount, ts FROM sales",
    "retained_rows": """SELECT event_id, ts, value FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 10081 MINUTE""",
    "retained_files": """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows,
       (epoch_ms((SELECT max(ts) FROM events)) - epoch_ms(max(ts))) // 60000 <= 10080 AS kept
FROM events GROUP BY 1""",
    "request_logs_latest": _LATEST_SQL,
    "request_log_replaced": f"""WITH {LOG_SQL}
SELECT "timestamp", t, hour, requests, round(size, 6) AS size,
       CASE WHEN hour < 8 THEN y + 1 ELSE y END AS y, round(drift_factor, 9) AS drift_factor
FROM log""",
    "warehouse_latest": _LATEST_SQL,
    "warehouse_absent": """SELECT event_id, user_id, value FROM events b WHERE event_type = 'purchase'
AND NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = 'error' AND hour(e.ts) < 2 AND e.user_id = b.user_id)""",
    "inferred_with_bad_values": f"""WITH {SALES_SQL},
marked AS (SELECT *, item = 'error' AND ts % 2 = 0 AS cut, item = 'signup' AND ts % 3 = 0 AND amount IS NOT NULL AS worded FROM sales)
SELECT item, count(*) AS n_rows, CAST(sum(CAST(CASE WHEN NOT worded THEN amount END AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount
FROM marked WHERE NOT cut GROUP BY item
UNION ALL SELECT 'rejected lines', count(*), NULL FROM marked WHERE cut HAVING count(*) > 0
UNION ALL SELECT 'rejected amount', count(*), NULL FROM marked WHERE worded HAVING count(*) > 0""",
    "request_log_daily": f"""WITH {LOG_SQL}
SELECT "timestamp", t, requests, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS day,
       CASE WHEN hour >= 12 AND t > (SELECT max(t) FROM log) - 100 THEN y + 3 WHEN hour >= 8 THEN y + 2 ELSE y + 1 END AS y
FROM log""",
    "latest_state": f"WITH {_STATE_SQL} SELECT key, value, updated_at FROM state",
    "seeded_state": f"""WITH {_STATE_SQL},
seeds AS (
    SELECT * FROM (VALUES ('last_y', 0.0::DOUBLE, TIMESTAMP '2024-01-01 00:00:00'),
                          ('8', 0.0::DOUBLE, TIMESTAMP '2024-01-01 00:00:00')) v(key, value, updated_at)
)
SELECT key, value, updated_at FROM state
UNION ALL
SELECT key, value, updated_at FROM seeds WHERE NOT EXISTS (SELECT 1 FROM state WHERE state.key = seeds.key)""",
    "sales_stream_totals": TOTALS_SQL,
    "request_log_stream_upsert": _LATEST_SQL,
}
