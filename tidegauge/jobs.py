"""Command-line jobs for ``spark-submit``; master, memory and the like are left to the caller.

    spark-submit tidegauge/jobs.py load-sales --source DIR --table DIR
"""

from __future__ import annotations

import argparse
import datetime
import sys
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession

from tidegauge.constants import FEATURES, LABEL, LAG_SEED, RETENTION_MINUTES
from tidegauge.files import list_files
from tidegauge.operators.aggregates import grand_total
from tidegauge.operators.daily import merge_loads, read_daily
from tidegauge.operators.latest import compact, read_replacing
from tidegauge.operators.retention import file_ages, purge
from tidegauge.plans.requests import LOG_KEY, request_days
from tidegauge.plans.sales import load_sales, sales_trend, store_trend
from tidegauge.plans.walk_forward_forest import evaluate_forest, kept_models, read_series, stored_metrics
from tidegauge.plans.walk_forward_forest_grouped import evaluate_forest_grouped
from tidegauge.plans.walk_forward_linear import complete_rows
from tidegauge.schemas import REQUEST_LOG, REQUEST_LOGS, SALES
from tidegauge.sinks import write_with_fallback
from tidegauge.sources import scan_inferred, scan_table, stream_json_lines
from tidegauge.sources.json_lines import DEFAULT_GLOB
from tidegauge.streaming import console_word_count, repartitioned_word_count, running_word_count, stream_lagged, stream_log, stream_scores, stream_series, stream_totals

PEEK_ROWS = 5


def _sales(spark: SparkSession, a: argparse.Namespace) -> None:
    if not load_sales(spark, a.source, a.table, rejects=a.rejects):
        print("no sales to load")


def _sales_stream(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = stream_json_lines(spark, a.source, SALES, max_files=a.max_files, archive=a.archive).lines
    stream_totals(lines, a.table, a.checkpoint, every=a.every, rejects=a.rejects).awaitTermination()


def _trend(spark: SparkSession, a: argparse.Namespace) -> None:
    stats = scan_table(spark, a.table)
    sales_trend(stats).show()
    store_trend(stats, a.results)


def _requests(spark: SparkSession, a: argparse.Namespace) -> None:
    lines = stream_json_lines(spark, a.source, REQUEST_LOG, max_files=a.max_files, archive=a.archive).lines
    table = request_days(a.table).arrivals if a.daily else a.table
    stream_log(lines, table, a.checkpoint, every=a.every, rejects=a.rejects).awaitTermination()


def _merge(spark: SparkSession, a: argparse.Namespace) -> None:
    daily = request_days(a.table)
    print(f"loads merged: {merge_loads(spark, daily)}")
    read_daily(spark, daily).printSchema()


def _lags(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = stream_json_lines(spark, a.source, REQUEST_LOG, max_files=a.max_files).rows.drop("y_lag1")
    stream_lagged(rows, a.table, a.checkpoint, LABEL, LAG_SEED, delay=a.delay, partitions=a.partitions, every=a.every).awaitTermination()


def _compact(spark: SparkSession, a: argparse.Namespace) -> None:
    compact(spark, a.table, a.target, REQUEST_LOGS, LOG_KEY)
    read_replacing(spark, a.target, REQUEST_LOGS, LOG_KEY).printSchema()


def _drift(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.source:
        lines = stream_json_lines(spark, a.source, REQUEST_LOG).lines
        stream_series(lines, a.series, a.checkpoint, rejects=a.rejects).awaitTermination()
    series = read_series(spark, a.series, [*FEATURES, LABEL])
    if series is None or series.isEmpty():
        print("no series to evaluate")
        return
    skipped = series.count() - complete_rows(series, [*FEATURES, LABEL]).count()
    if skipped:
        print(f"rows with a missing value, left out: {skipped}")
    if a.grouped:
        evaluate_forest_grouped(spark, a.series, a.metrics, restart_grid=a.restart_grid)
    else:
        evaluate_forest(spark, a.series, a.metrics, parallelism=a.parallelism, restart_grid=a.restart_grid, models=a.models)
    stored_metrics(spark, a.metrics).orderBy("t_end").show()


def _score(spark: SparkSession, a: argparse.Namespace) -> None:
    """Predictions of kept models for a later series, or for arriving records by the newest of them."""
    models = kept_models(spark, a.models)
    if a.series:
        models.scored(spark.read.parquet(a.series), FEATURES).write.mode("overwrite").parquet(a.table)
        return
    newest = models.newest()
    if newest is None:
        print("no model to score with")
        return
    rows = stream_json_lines(spark, a.source, REQUEST_LOG).rows
    stream_scores(rows, newest[1], FEATURES, a.table, a.checkpoint).awaitTermination()


def _amounts(spark: SparkSession, a: argparse.Namespace) -> None:
    records: DataFrame = scan_inferred(spark, a.source)
    if records.isEmpty():
        print("no records")
        return
    records.printSchema()
    records.show(PEEK_ROWS)
    print(write_with_fallback(grand_total(records), [p for p in (a.table, a.fallback) if p]))


def _words(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.continues:
        if not (a.table and a.partitions) or a.restart:
            raise SystemExit("--continues needs a new --table and --partitions, and no --restart")
        query = repartitioned_word_count(spark, a.source, a.table, a.checkpoint, a.continues, partitions=a.partitions, every=a.every)
    elif a.table:
        query = running_word_count(
            spark, a.source, a.table, a.checkpoint, partitions=a.partitions, every=a.every, restart=a.restart
        )
    else:
        query = console_word_count(spark, a.source, a.checkpoint, partitions=a.partitions, every=a.every)
    query.awaitTermination()


def _retain(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.dry_run:
        ages = file_ages(list_files(spark, a.source, a.glob), datetime.datetime.now(datetime.UTC), a.minutes)
        ages.orderBy("modified").show(truncate=False)
    else:
        print(f"files deleted: {purge(spark, a.source, minutes=a.minutes, glob=a.glob)}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidegauge")
    commands = top.add_subparsers(required=True)

    def command(name: str, run, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        return sub

    def arriving(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--every", help="keep running, one batch per interval, such as '10 minutes'")
        sub.add_argument("--max-files", type=int)
        sub.add_argument("--archive", help="where finished source files move")
        sub.add_argument("--rejects", help="text table for lines that are no records")

    command("load-sales", _sales, ("source", "table"), ("rejects",))
    arriving(command("stream-sales", _sales_stream, ("source", "table", "checkpoint")))
    command("sales-trend", _trend, ("table", "results"))
    requests = command("load-requests", _requests, ("source", "table", "checkpoint"))
    arriving(requests)
    requests.add_argument("--daily", action="store_true", help="into a table kept by days, for merge-requests")
    command("merge-requests", _merge, ("table",))
    lags = command("stream-lags", _lags, ("source", "table", "checkpoint"), ("every",))
    lags.add_argument("--max-files", type=int)
    lags.add_argument("--partitions", type=int)
    lags.add_argument("--delay", type=int, default=0, help="time units that a row waits for earlier ones")
    command("compact-requests", _compact, ("table", "target"))
    drift = command("evaluate-drift", _drift, ("series", "metrics"), ("source", "checkpoint", "rejects"))
    drift.add_argument("--restart-grid", action="store_true", help="count window ends anew from the first row")
    drift.add_argument("--parallelism", type=int)
    drift.add_argument("--grouped", action="store_true", help="all windows in one go, for a backfill")
    drift.add_argument("--models", help="folder that fitted forests are kept in")
    command("score-requests", _score, ("models", "table"), ("series", "source", "checkpoint"))
    command("total-amount", _amounts, ("source", "table"), ("fallback",))
    words = command("count-words", _words, ("source", "checkpoint"), ("table", "every"))
    words.add_argument("--partitions", type=int)
    words.add_argument("--restart", action="store_true")
    words.add_argument("--continues", help="checkpoint of a stopped count, whose state goes on with another number of partitions")
    retain = command("retain-files", _retain, ("source",))
    retain.add_argument("--minutes", type=int, default=RETENTION_MINUTES)
    retain.add_argument("--glob", default=DEFAULT_GLOB)
    retain.add_argument("--dry-run", action="store_true", help="list the files and what would become of them")
    return top


def main(argv: list[str] | None = None) -> None:
    top = parser()
    arguments = top.parse_args(argv)
    if arguments.run is _drift and arguments.source and not arguments.checkpoint:
        top.error("evaluate-drift --source needs --checkpoint")
    if arguments.run is _score and not (arguments.series or (arguments.source and arguments.checkpoint)):
        top.error("score-requests needs --series, or --source and --checkpoint")
    if getattr(arguments, "archive", None) and not arguments.rejects:
        # A line that is no record would otherwise leave with its file, and be nowhere.
        top.error("--archive needs --rejects")
    spark = SparkSession.builder.appName("tidegauge").getOrCreate()
    arguments.run(spark, arguments)


if __name__ == "__main__":
    main()
