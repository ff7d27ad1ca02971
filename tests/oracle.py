"""Compare a registered query with its SQL on DuckDB, row for row."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

from tidegauge.catalog import ORACLES, QUERIES


def oracle_rows(sf_dir: str, name: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    con.execute(ORACLES[name])
    columns = [d[0] for d in con.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), Counter(tuple(row[i] for i in order) for row in con.fetchall())


def spark_rows(spark, sf_dir: str, name: str) -> tuple[list[str], Counter]:
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    return columns, Counter(tuple(row) for row in df.select(*columns).collect())
