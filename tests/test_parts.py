"""A numbered part is visible whole or not at all."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegauge.operators.latest import read_parts
from tidegauge.sinks import write_lines, write_part

SCHEMA = "id BIGINT"


def broken(spark, at):
    """Rows of which the task that has row ``at`` fails, after others have ended."""
    rows = spark.range(0, 100, 1, 10)
    return rows.select(F.when(F.col("id") == at, F.raise_error(F.lit("cut off")).cast("bigint")).otherwise(F.col("id")).alias("id"))


def parts_of(spark, path):
    return sorted(tuple(r) for r in read_parts(spark, path, SCHEMA).groupBy("part").count().collect())


def test_a_write_that_breaks_off_leaves_nothing_and_spoils_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(PySparkException):
        write_part(broken(spark, 95), path, 0)
    assert parts_of(spark, path) == []
    write_part(spark.range(7), path, 0)
    with pytest.raises(PySparkException):
        write_part(broken(spark, 95), path, 0)
    with pytest.raises(PySparkException):
        write_part(broken(spark, 0), path, 1)
    assert parts_of(spark, path) == [(0, 7)]
    write_part(spark.range(5), path, 1, ["id"])
    write_part(spark.range(3), path, 0)
    assert parts_of(spark, path) == [(0, 3), (1, 5)]


def test_what_was_read_before_a_part_was_replaced_can_make_the_new_one(spark, tmp_path):
    path = str(tmp_path / "t")
    write_part(spark.range(10), path, 0)
    write_part(read_parts(spark, path, SCHEMA).drop("part").filter("id < 4"), path, 0)
    assert parts_of(spark, path) == [(0, 4)]


def test_lines_as_well(spark, tmp_path):
    path = str(tmp_path / "lines")
    write_lines(spark.createDataFrame([("a",), ("b",)], "value STRING"), path, 0)
    with pytest.raises(PySparkException):
        write_lines(broken(spark, 95).select(F.col("id").cast("string").alias("value")), path, 0)
    write_lines(spark.createDataFrame([("c",)], "value STRING"), path, 1)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a", "b", "c"]
