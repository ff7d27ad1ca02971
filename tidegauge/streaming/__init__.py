"""Structured Streaming jobs. Each ends when the files present at its start are processed,
unless a trigger says otherwise, and continues from its checkpoint when started again."""

from tidegauge.streaming.handover import read_files, repartitioned_word_count, stored_counts
from tidegauge.streaming.lag import lagged, stored_lags, stream_lagged
from tidegauge.streaming.loads import stream_latest, stream_log, stream_scores, stream_series, stream_totals
from tidegauge.streaming.word_count import console_word_count, read_counts, running_word_count

__all__ = ["console_word_count", "lagged", "read_counts", "read_files", "repartitioned_word_count", "running_word_count", "stored_counts", "stored_lags", "stream_lagged", "stream_latest", "stream_log", "stream_scores", "stream_series", "stream_totals"]
