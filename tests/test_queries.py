"""Every registered query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from oracle import oracle_rows, spark_rows
from tidegauge.catalog import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert spark_rows(spark, SMALL, name) == oracle_rows(SMALL, name)


@pytest.mark.parametrize(
    "name",
    [
        "latest_state",
        "request_features",
        "request_log_replaced",
        "request_log_stream_upsert",
        "retained_rows",
        "sales_stats",
        "seeded_state",
        "stats_history",
        "union_inputs",
    ],
)
def test_results_do_not_depend_on_the_session_time_zone(spark, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert spark_rows(spark, SMALL, name) == oracle_rows(SMALL, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_contract(spark):
    assert QUERIES.keys() == ORACLES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    metrics = contract.entry(spark)
    assert metrics.columns == ["t_end", "n_train", "n_test", "complete", "within_range"]
    assert metrics.count() == contract.queries()["walk_forward_linear"](spark, SMALL).count()
