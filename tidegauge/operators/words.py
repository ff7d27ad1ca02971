"""Word counts, for batch and streaming input alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import words


def lines_of(df: DataFrame, text: str) -> DataFrame:
    """Rows ``value`` as a text file of that column would have them: cut at line feeds, nulls left out."""
    return df.select(F.explode(F.split(F.col(text), "\n")).alias("value"))


def word_counts(lines: DataFrame, text: str = "value") -> DataFrame:
    return lines.select(F.explode(words(text)).alias("word")).groupBy("word").count()
