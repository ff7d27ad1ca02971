"""Bucketed tables need no shuffle by their key; one bad value costs nothing but itself."""

from __future__ import annotations

import json

import pytest

from tidegauge.operators.aggregates import totals
from tidegauge.operators.latest import absent_from, latest_rows
from tidegauge.sinks import WarehouseTable
from tidegauge.sources import scan_inferred_fields, scan_variants, split_fields
from tidegauge.sources.variants import inferred_schema

SCHEMA = "k BIGINT, v BIGINT, name STRING"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def made(spark, tmp_path):
    tables = [WarehouseTable(f"warehouse_test_{n}", SCHEMA, str(tmp_path / n), ["k"], 4) for n in ("a", "b")]
    yield tables
    for t in tables:
        t.drop(spark)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_rows_and_absent_ones_without_a_shuffle(spark, made, no_broadcast):
    a, b = made
    for load in range(3):
        a.insert(spark.createDataFrame([(k, load, f"{load}") for k in range(load, 40, load + 1)], SCHEMA).select("name", "v", "k"))
    b.insert(spark.createDataFrame([(k, 0, "") for k in range(0, 40, 3)], SCHEMA))
    latest, absent = latest_rows(a.create(spark), ["k"], ["v"]), absent_from(a.create(spark), b.create(spark), ["k"])
    both = latest_rows(absent, ["k"], ["v"])
    for df in (latest, absent, both):
        assert "Exchange" not in plan_of(df)
    last = {k: max(load for load in range(3) if k >= load and (k - load) % (load + 1) == 0) for k in range(40)}
    assert {r["k"]: (r["v"], r["name"]) for r in latest.collect()} == {k: (v, f"{v}") for k, v in last.items()}
    assert {r["k"] for r in absent.collect()} == {k for k in range(40) if k % 3}


def test_one_key_reads_one_bucket(spark, made):
    a, _ = made
    a.insert(spark.createDataFrame([(k, 0, "") for k in range(100)], SCHEMA))
    one = a.create(spark).filter("k = 17")
    assert one.count() == 1
    # The plan names buckets where the scan keeps them apart.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 4" in plan_of(a.create(spark).filter("k = 17"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_files_outlive_the_catalog(spark, made):
    a, _ = made
    a.insert(spark.createDataFrame([(1, 2, "x")], SCHEMA))
    a.drop(spark)
    assert [tuple(r) for r in a.create(spark).collect()] == [(1, 2, "x")]
    assert a.create(spark).count() == 1  # defined already


def test_an_empty_table_and_an_empty_load(spark, made):
    a, _ = made
    assert a.create(spark).count() == 0
    a.insert(spark.createDataFrame([], SCHEMA))
    assert latest_rows(a.create(spark), ["k"], ["v"]).count() == 0


def put(folder, lines):
    folder.mkdir(exist_ok=True)
    (folder / "a.json").write_text("".join(line + "\n" for line in lines))
    return str(folder)


def test_one_bad_value_costs_only_itself(spark, tmp_path):
    lines = [json.dumps({"item": "mouse", "amount": a, "ts": 1}) for a in (70, 50.5, "x", "30", None, [1], 10)]
    lines += ["BROKEN", "[1, 2]", "7", "", '{"item": "cut', json.dumps({"ts": "soon"}), json.dumps({"item": 5, "amount": 1, "other": {"deep": True}})]
    scan = scan_inferred_fields(spark, put(tmp_path / "in", lines))
    assert dict(scan.rows.dtypes) == {"amount": "double", "item": "string", "other": "string", "ts": "bigint"}
    assert [(r["item"], r["total_amount"]) for r in totals(scan.rows.where("item = 'mouse'")).collect()] == [("mouse", 160.5)]
    got = sorted((r["field"] or "", r["value"]) for r in scan.rejects.collect())
    assert got == [("", "7"), ("", "BROKEN"), ("", "[1, 2]"), ("", '{"item": "cut'), ("amount", "[1]"), ("amount", "x"), ("ts", "soon")]
    assert scan.rows.count() == 9 and {r["item"] for r in scan.rows.where("amount = 1").collect()} == {"5"}


def test_types_by_most_values(spark, tmp_path):
    lines = [json.dumps(v) for v in ({"a": 1, "b": True, "c": "x", "d e'f": 1}, {"a": "x", "b": True, "c": 5, "d e'f": 2.5}, {"a": 2, "b": "maybe", "c": "y", "g": None}, {"a": 1e300})]
    found = scan_variants(spark, put(tmp_path / "in", lines))
    assert inferred_schema(found) == "`a` DOUBLE, `b` BOOLEAN, `c` STRING, `d e'f` DOUBLE"
    scan = split_fields(found, inferred_schema(found))
    assert [r["d e'f"] for r in scan.rows.where("`d e'f` IS NOT NULL").orderBy("d e'f").collect()] == [1.0, 2.5]
    assert sorted(map(tuple, scan.rejects.collect())) == [("a", "x"), ("b", "maybe")]


def test_declared_fields_need_not_occur(spark, tmp_path):
    scan = split_fields(scan_variants(spark, put(tmp_path / "in", ['{"a": 1}', ""])), "a INT, z DOUBLE")
    assert [tuple(r) for r in scan.rows.collect()] == [(1, None)] and scan.rejects.count() == 0
