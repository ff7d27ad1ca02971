"""Tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(text: str = "value") -> Column:
    """Tokens between single spaces; repeated blanks give empty tokens, null gives none."""
    return F.split(F.col(text), " ")
