"""Queries on streams that keep state between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.catalog.inputs import FILES, SCALE, table
from tidegauge.constants import LAG_SEED
from tidegauge.files import Store, list_files, paths_of
from tidegauge.functions import epoch_units, exact_sum
from tidegauge.scratch import fresh_folder
from tidegauge.sources import scan_table, stream_json_lines
from tidegauge.streaming.lag import stream_lagged

HOURLY = "event_type STRING, t BIGINT, y DOUBLE"
# Hours by which rows arrive out of order, and the time that a row waits for earlier ones.
DISORDER = 5
DELAY = 4


def hourly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly totals of each type of event."""
    return table(spark, sf_dir, "events").groupBy("event_type", epoch_units("ts", "HOUR").alias("t")).agg(exact_sum("value", SCALE).alias("y"))


def arriving_in_order(spark: SparkSession, rows: DataFrame, number: F.Column, label: str) -> str:
    """JSON files by their number, as old as their number says, so that a stream takes them in that order."""
    source = fresh_folder(spark, label)
    rows.withColumn("n", number).repartition(FILES, "n").write.partitionBy("n").json(source)
    store = Store(spark, source)
    for path, _ in paths_of(list_files(spark, source, "*.json")):
        store.set_modified(path, 1_000_000_000_000 + 1000 * int(path.split("/n=")[1].split("/")[0]))
    return f"{source}/*"


def series_on_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags of a series for each type, from files that overlap in time, by a stream that stops and starts again."""
    hourly = hourly_by_type(spark, sf_dir)
    low, high = hourly.agg(F.min("t"), F.max("t")).first()
    number = F.floor((F.col("t") + F.col("t") % DISORDER - low) * FILES / (high - low + DISORDER)).cast("int")
    source = arriving_in_order(spark, hourly, number, "hourly-arriving")
    place, checkpoint = fresh_folder(spark, "lags"), fresh_folder(spark, "checkpoint")
    for glob in (f"{source[:-1]}n=[0-{FILES // 2 - 1}]", source):
        rows = stream_json_lines(spark, glob, HOURLY, max_files=1).rows
        stream_lagged(rows, place, checkpoint, "y", LAG_SEED, keys=["event_type"], delay=DELAY, partitions=4).awaitTermination()
    return scan_table(spark, place).select("event_type", "t", "y", "y_lag1", "place")


QUERIES = {
    "series_on_a_stream": series_on_a_stream,
}

ORACLES = {
    "series_on_a_stream": f"""WITH hourly AS (
    SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS t, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS y
    FROM events GROUP BY 1, 2
),
lagged AS (
    SELECT *, row_number() OVER series AS nth, lag(y) OVER series AS before, max(t) OVER (PARTITION BY event_type) AS youngest
    FROM hourly WINDOW series AS (PARTITION BY event_type ORDER BY t)
)
SELECT event_type, t, y, CASE WHEN nth = 1 THEN 0.0 ELSE before END AS y_lag1, 'in order' AS place
FROM lagged WHERE t <= youngest - {DELAY}""",
}
