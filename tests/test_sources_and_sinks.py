from __future__ import annotations

import datetime
import json
import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from tidegauge.catalog import QUERIES
from tidegauge.operators.aggregates import average, bounds, totals
from tidegauge.schemas import REQUEST_LOG, SALES, WORD_COUNT
from tidegauge.scratch import fresh_folder, release, shared_base
from tidegauge.sinks import append_sorted, create_absent, stamped, truncate, write_part, write_snapshot, write_with_fallback
from tidegauge.sources import (
    empty_table,
    integers,
    literal_rows,
    newest,
    scan_inferred,
    scan_json_lines,
    scan_present,
    scan_table,
)
from tidegauge.operators.retention import retained_since


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text("".join(line + "\n" for line in lines))
    return path


def sale(item, amount, ts=1):
    return json.dumps({"item": item, "amount": amount, "ts": ts})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_absent_path_is_an_empty_table_of_the_schema(spark, tmp_path):
    scan = scan_json_lines(spark, str(tmp_path / "nowhere"), SALES)
    assert scan.rows.columns == ["item", "amount", "ts"]
    assert scan.rows.count() == 0 and scan.rejects.count() == 0
    assert totals(scan.rows).count() == 0


def test_empty_directory_is_an_empty_table(spark, tmp_path):
    assert scan_json_lines(spark, str(tmp_path), SALES).rows.isEmpty()


def test_other_problems_are_not_swallowed(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan_json_lines(spark, "nosuchscheme://x/y", "item NOTATYPE")


def test_malformed_lines_are_rejects_whatever_is_selected(spark, tmp_path):
    write_lines(tmp_path, "a.json", [sale("mouse", 50), "BROKEN", sale("mouse", "x"), "", sale("screen", 70.5)])
    scan = scan_json_lines(spark, str(tmp_path), SALES)
    assert rows(scan.rows) == [("mouse", 50.0, 1), ("screen", 70.5, 1)]
    assert scan.rows.count() == 2 and scan.rejects.count() == 2
    assert not scan.rows.isEmpty() and not scan.rejects.isEmpty()
    # The bad amount is a reject even where only the item is read.
    assert rows(scan.rows.select("item")) == [("mouse",), ("screen",)]
    assert {r[0] for r in scan.rejects.select("_corrupt_record").collect()} == {"BROKEN", sale("mouse", "x")}
    assert rows(totals(scan.rows)) == [("mouse", 50.0), ("screen", 70.5)]


def test_only_json_files_are_read(spark, tmp_path):
    write_lines(tmp_path, "a.json", [sale("mouse", 50)])
    write_lines(tmp_path, "b.tmp", [sale("mouse", 50)])
    assert scan_json_lines(spark, str(tmp_path), SALES).rows.count() == 1


def test_inferred_schema_turns_to_text_on_one_bad_value(spark, tmp_path):
    write_lines(tmp_path / "good", "a.json", [sale("mouse", 50), sale("mouse", 60)])
    write_lines(tmp_path / "bad", "a.json", [sale("mouse", 70), sale("mouse", "x")])
    assert dict(scan_inferred(spark, str(tmp_path / "good")).dtypes)["amount"] == "bigint"
    assert dict(scan_inferred(spark, str(tmp_path / "bad")).dtypes)["amount"] == "string"


def test_union_matches_columns_by_name_and_keeps_duplicates(spark, tmp_path):
    write_lines(tmp_path / "archive", "a.json", [sale("mouse", 50)])
    write_lines(tmp_path / "success", "b.json", ['{"ts":1,"amount":50,"item":"mouse"}'])
    both = scan_present(spark, [str(tmp_path / d) for d in ("archive", "success", "absent")], SALES).rows
    assert rows(both) == [("mouse", 50.0, 1)] * 2


def test_files_past_their_retention_are_not_listed(spark, tmp_path):
    now = datetime.datetime(2024, 5, 8, 12, 0, 0)
    ages = {"young": 10080 * 60 + 59, "old": 10081 * 60}
    for name, seconds in ages.items():
        path = write_lines(tmp_path, f"{name}.json", [sale(name, 1)])
        stamp = now.replace(tzinfo=datetime.timezone.utc).timestamp() - seconds
        os.utime(path, (stamp, stamp))
    kept = scan_json_lines(spark, str(tmp_path), SALES, modified_after=retained_since(now)).rows
    assert rows(kept.select("item")) == [("young",)]


def test_literal_rows_average_and_round_trip(spark, tmp_path):
    people = literal_rows(spark, [("Alice", 25), ("Bob", 30), ("Charlie", 35)], ["name", "age"])
    assert average(people, "age").first()[0] == 30.0
    path = write_snapshot(people, str(tmp_path / "people"))
    assert rows(scan_table(spark, path)) == rows(people)


def test_integers(spark):
    assert [r[0] for r in integers(spark, 6).filter("id > 0").selectExpr("id * 2").collect()] == [2, 4, 6, 8, 10]
    assert integers(spark, 10).groupBy().sum("id").first()[0] == 45


def test_bounds_of_nothing_is_no_row(spark):
    assert bounds(empty_table(spark, REQUEST_LOG), "t").count() == 0


def test_fallback_path_is_used_when_the_first_one_fails(spark, tmp_path):
    (tmp_path / "blocked").write_text("a file, not a folder")
    table = literal_rows(spark, [("Hello", 1), ("World", 2), ("Tables", 3), ("Spark", 4)], ["word", "count"])
    used = write_with_fallback(table, [str(tmp_path / "blocked" / "t"), str(tmp_path / "open")])
    assert used == str(tmp_path / "open")
    assert scan_table(spark, used).count() == 4


def test_fallback_reports_the_last_failure(spark, tmp_path):
    (tmp_path / "blocked").write_text("a file, not a folder")
    with pytest.raises(Exception):
        write_with_fallback(integers(spark, 1), [str(tmp_path / "blocked" / "t")])


def test_append_creates_then_grows_and_files_are_sorted(spark, tmp_path):
    path = str(tmp_path / "t")
    for start in (0, 5):
        append_sorted(spark.range(start, start + 5).selectExpr("-id AS id").coalesce(1), path, ["id"])
    assert rows(scan_table(spark, path)) == sorted([(-i,) for i in range(10)], key=repr)
    for file in scan_table(spark, path).inputFiles():
        ids = [r[0] for r in spark.read.parquet(file).collect()]
        assert ids == sorted(ids)


def test_writing_a_part_again_replaces_it_only(spark, tmp_path):
    path = str(tmp_path / "t")
    for part, n in ((0, 3), (1, 4), (0, 2)):
        write_part(spark.range(n), path, part)
    assert scan_table(spark, path).count() == 6


def test_truncate_and_create_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    assert scan_table(spark, truncate(spark, path, WORD_COUNT)).count() == 0
    write_snapshot(literal_rows(spark, [("a", 1)], WORD_COUNT), path)
    assert scan_table(spark, create_absent(spark, path, WORD_COUNT)).count() == 1
    assert scan_table(spark, truncate(spark, path, WORD_COUNT)).count() == 0


def test_stamp_is_a_parameter(spark):
    at = datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert stamped(spark.range(1), at).first()["processed_at"] == at
    assert stamped(spark.range(1)).first()["processed_at"] is not None


def test_newest_is_planned_as_a_distributed_top_n(spark, tmp_path):
    path = write_snapshot(spark.range(1000), str(tmp_path / "t"))
    top = newest(scan_table(spark, path), ["id"], ["id"], 100)
    assert [r[0] for r in top.collect()] == list(range(999, 899, -1))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_scratch_is_below_the_configured_folder(spark):
    a, b = fresh_folder(spark, "x"), fresh_folder(spark, "x")
    assert a != b and a.startswith(shared_base(spark)) and b.startswith(shared_base(spark))
    assert shared_base(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_a_finished_query_leaves_only_its_result(spark, tmp_path):
    release(spark)
    path = write_snapshot(QUERIES["request_log_replaced"](spark, "/root/testdata/sf0.001"), str(tmp_path / "result"))
    base = Path(shared_base(spark)) / "tidegauge"
    assert list(base.iterdir()) and release(spark) > 0 and not list(base.iterdir())
    assert spark.read.parquet(path).count() > 0 and release(spark) == 0
