"""A table kept by days: loads replace only the days they touch, and none is lost."""

from __future__ import annotations

import datetime
import re
from pathlib import Path

import pytest

from tidegauge.operators import daily
from tidegauge.operators.daily import DailyTable, add_load, merge_loads, read_daily, whole_parts

SCHEMA = "at TIMESTAMP_NTZ, k BIGINT, y DOUBLE, version BIGINT"


@pytest.fixture
def table(tmp_path):
    return DailyTable(str(tmp_path / "table"), SCHEMA, ["at", "k"], "at", ["version"])


def day(n, hour=0):
    return datetime.datetime(2024, 5, n, hour)


def load(spark, table, part, *rows):
    add_load(spark.createDataFrame([(*r, *(0,) * (4 - len(r))) for r in rows], SCHEMA), table, part)


def content(spark, table):
    rows = [tuple(r)[:3] for r in read_daily(spark, table).select("at", "k", "y").collect()]
    assert len(rows) == len({r[:2] for r in rows})
    return {r[:2]: r[2] for r in rows}


def files(table):
    return {p.relative_to(table.path): p.stat().st_mtime_ns for p in Path(table.path).rglob("*.parquet")}


def test_loads_replace_rows_before_and_after_a_merge(spark, table):
    assert content(spark, table) == {} and merge_loads(spark, table) == 0
    load(spark, table, 0, (day(1), 1, 1.0), (day(1), 2, 1.0), (day(2), 1, 1.0), (None, 1, 1.0))
    want = {(day(1), 1): 1.0, (day(1), 2): 1.0, (day(2), 1): 1.0, (None, 1): 1.0}
    assert content(spark, table) == want
    assert merge_loads(spark, table) == 1 and content(spark, table) == want and whole_parts(spark, table) == []
    load(spark, table, 1, (day(2), 1, 2.0), (day(3), 1, 2.0), (None, 1, 2.0))
    load(spark, table, 2, (day(3), 1, 3.0), (day(3, 5), 1, 3.0, 1), (day(3, 5), 1, 9.0, 0))
    want |= {(day(2), 1): 2.0, (day(3), 1): 3.0, (day(3, 5), 1): 3.0, (None, 1): 2.0}
    assert content(spark, table) == want
    assert merge_loads(spark, table) == 2 and content(spark, table) == want
    load(spark, table, 3, (day(1), 2, 4.0))
    load(spark, table, 3, (day(1), 1, 5.0))  # the same load again
    assert content(spark, table) == want | {(day(1), 1): 5.0}


def test_a_merge_writes_and_reads_touched_days_alone(spark, table):
    load(spark, table, 0, *((day(d), k, 1.0) for d in range(1, 11) for k in range(3)))
    merge_loads(spark, table)
    before = files(table)
    load(spark, table, 1, (day(4), 1, 2.0))
    plan = read_daily(spark, table)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert any("day#" in f and "NOT" in f for f in filters) and any("2024-05-04" in f and "NOT" not in f for f in filters)
    merge_loads(spark, table)
    after = files(table)
    changed = {str(p.parent.name) for p in before.items() ^ after.items() for p in [p[0]]}
    assert changed == {"day=2024-05-04"}
    assert content(spark, table)[day(4), 1] == 2.0 and len(content(spark, table)) == 30


def test_without_waiting_loads_reading_is_a_plain_scan(spark, table):
    load(spark, table, 0, (day(1), 1, 1.0))
    merge_loads(spark, table)
    plan = read_daily(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan


def test_a_load_that_arrives_during_a_merge_is_not_lost(spark, table, monkeypatch):
    load(spark, table, 0, (day(1), 1, 1.0), (day(2), 1, 1.0))
    days_of = daily._days_of

    def meanwhile(waiting):
        load(spark, table, 1, (day(1), 1, 2.0), (day(9), 1, 2.0))
        return days_of(waiting)

    monkeypatch.setattr(daily, "_days_of", meanwhile)
    assert merge_loads(spark, table) == 1
    monkeypatch.undo()
    want = {(day(1), 1): 2.0, (day(2), 1): 1.0, (day(9), 1): 2.0}
    assert whole_parts(spark, table) == [1] and content(spark, table) == want
    assert merge_loads(spark, table) == 1 and content(spark, table) == want


def test_a_merge_that_breaks_off_is_made_up_for(spark, table, monkeypatch):
    load(spark, table, 0, (day(1), 1, 1.0))
    merge_loads(spark, table)
    load(spark, table, 1, (day(1), 1, 2.0), (day(2), 1, 2.0))

    def no_deletion(self, path, recursive=False):
        if "arrivals" in path:
            raise OSError("gone")
        return delete(self, path, recursive)

    delete = daily.Store.delete
    monkeypatch.setattr(daily.Store, "delete", no_deletion)
    with pytest.raises(OSError):
        merge_loads(spark, table)
    monkeypatch.undo()
    want = {(day(1), 1): 2.0, (day(2), 1): 2.0}
    assert content(spark, table) == want
    assert merge_loads(spark, table) == 1 and content(spark, table) == want


def test_one_merge_at_a_time_and_parts_that_are_not_whole_wait(spark, table):
    load(spark, table, 0, (day(1), 1, 1.0))
    load(spark, table, 1, (day(1), 1, 2.0))
    store = daily.Store(spark, table.path)
    store.delete(f"{table.arrivals}/part=1/_SUCCESS")
    assert content(spark, table) == {(day(1), 1): 1.0}
    assert store.create_new(table.lock) and not store.create_new(table.lock)
    with pytest.raises(RuntimeError, match="another merge"):
        merge_loads(spark, table)
    store.delete(table.lock)
    assert merge_loads(spark, table) == 1 and not store.exists(table.lock)
