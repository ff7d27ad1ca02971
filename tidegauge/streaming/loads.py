"""Load newly arrived records, each file once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidegauge.operators.latest import latest_rows
from tidegauge.plans.models import predicted
from tidegauge.plans.requests import LOG_KEY, checked_times, stored_log
from tidegauge.plans.sales import STATS_ORDER, sales_stats
from tidegauge.sinks import write_lines, write_part
from tidegauge.sources.json_lines import CORRUPT, rejected_lines, split_rejects
from tidegauge.streaming.runs import start


def _load(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    per_batch: Callable[[DataFrame], DataFrame],
    sort_by: Sequence[str],
    every: str | None,
    rejects: str | None = None,
) -> StreamingQuery:
    """``rows`` are records, or marked lines (``JsonScan.lines``), whose bad ones go to the text table ``rejects``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        if CORRUPT not in batch.columns:
            write_part(per_batch(batch), table, batch_id, sort_by)
            return
        batch = batch.persist()  # two tables are made of it, and its files are read once
        scan = split_rejects(batch)
        write_part(per_batch(scan.rows), table, batch_id, sort_by)
        if rejects is not None:
            write_lines(rejected_lines(scan.rejects), rejects, batch_id)
        batch.unpersist()

    return start(rows.writeStream.foreachBatch(store), checkpoint, every)


def stream_totals(
    sales: DataFrame,
    table: str,
    checkpoint: str,
    *,
    scale: int | None = None,
    every: str | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """Append the totals of each batch; the totals of all batches are their sums."""
    return _load(
        sales, table, checkpoint, lambda batch: sales_stats(batch, scale=scale), STATS_ORDER, every, rejects
    )


def stream_log(
    log: DataFrame, table: str, checkpoint: str, *, every: str | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Append request-log records in their stored form; read the table with ``read_replacing``.

    Of marked lines, those whose time is no time are rejects as well.
    """
    lines = checked_times(log) if CORRUPT in log.columns else log
    return _load(lines, table, checkpoint, stored_log, LOG_KEY, every, rejects)


def stream_series(
    log: DataFrame, table: str, checkpoint: str, *, every: str | None = None, rejects: str | None = None
) -> StreamingQuery:
    """Append request-log records unchanged, each file sorted by time: the input of an evaluation."""
    return _load(log, table, checkpoint, lambda batch: batch, ["t"], every, rejects)


def stream_scores(
    rows: DataFrame, model: Model, features: Sequence[str], table: str, checkpoint: str, *, every: str | None = None
) -> StreamingQuery:
    """Append the rows with the prediction of a model that was fitted before; incomplete rows are left out."""
    return _load(predicted(model, rows, features), table, checkpoint, lambda batch: batch, (), every)


def stream_latest(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    key: Sequence[str],
    version: Sequence[str],
    *,
    every: str | None = None,
) -> StreamingQuery:
    """Append each batch's latest row per key to a replacing table.

    A batch costs what it holds, not what the table holds: parts are merged when the table is
    read, or by compaction.
    """
    return _load(rows, table, checkpoint, lambda batch: latest_rows(batch, key, version), key, every)
