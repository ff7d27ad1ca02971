"""Catalog tables laid out by key: what groups or joins by it needs no shuffle.

A table is external: its files lie at a place of the caller's, in buckets by the hash of the key, sorted by it. The catalog
may forget the table, as one in memory does when the application ends; the same definition finds the files again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class WarehouseTable(NamedTuple):
    """Name in the catalog, columns as DDL, place, key and number of buckets.

    Tables that are joined by their keys need the same number of buckets. It is part of the layout: choose
    it for the size that the table will have, so that a bucket fits a task.
    """

    name: str
    schema: str
    path: str
    key: Sequence[str]
    buckets: int

    def create(self, spark: SparkSession) -> DataFrame:
        """Define the table unless the catalog has it; its rows so far."""
        key = ", ".join(f"`{k}`" for k in self.key)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.schema}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        return spark.table(self.name)

    def insert(self, df: DataFrame) -> None:
        """Append rows, matched by name: one file a bucket and load, written by as many tasks as there are buckets."""
        spark = df.sparkSession
        columns = self.create(spark).columns
        dealt = df.select(*columns).repartition(self.buckets, *self.key).sortWithinPartitions(*self.key)
        dealt.write.insertInto(self.name)
        spark.catalog.refreshTable(self.name)

    def drop(self, spark: SparkSession) -> None:
        """Take the table out of the catalog; its files stay."""
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
