"""Files are purged whole, by their modification time."""

from __future__ import annotations

import datetime
import os

import pytest

from tidegauge.files import Store, list_files, milliseconds
from tidegauge.operators import retention
from tidegauge.operators.retention import file_ages, purge

NOW = datetime.datetime(2024, 5, 8, 12, 0, 0)


def put(folder, name, minutes, seconds=0, text="{}\n"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    stamp = NOW.replace(tzinfo=datetime.UTC).timestamp() - 60 * minutes - seconds
    os.utime(path, (stamp, stamp))
    return path


def names(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


@pytest.fixture
def archive(tmp_path):
    folder = tmp_path / "archive"
    for name, minutes, seconds in (("new.json", 0, 0), ("future.json", -60, 0), ("last.json", 10080, 59), ("old.json", 10081, 0), ("deep/er/old.json", 20000, 0), ("deep/young.json", 5, 0), ("old.txt", 20000, 0), ("BROKEN .json", 10090, 0)):
        put(folder, name, minutes, seconds)
    return folder


def test_ages_in_whole_minutes_and_no_content(spark, archive):
    files = list_files(spark, str(archive), "*.json")
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    ages = {r["path"].rpartition("archive/")[2]: (r["age"], r["expired"]) for r in file_ages(files, NOW).collect()}
    assert ages["last.json"] == (10080, False) and ages["old.json"] == (10081, True)
    assert ages["future.json"] == (-60, False) and ages["deep/er/old.json"] == (20000, True)
    assert "old.txt" not in ages and len(ages) == 7


def test_a_second_purge_and_one_at_another_age_drop_exactly_the_right_files(spark, archive):
    assert purge(spark, str(archive), NOW) == 3
    left = ["deep/young.json", "future.json", "last.json", "new.json", "old.txt"]
    assert names(archive) == left
    assert purge(spark, str(archive), NOW) == 0 and names(archive) == left
    assert purge(spark, str(archive), NOW, 4, parallelism=1) == 2
    assert names(archive) == ["future.json", "new.json", "old.txt"]
    assert purge(spark, str(archive), NOW, 4, glob="*.txt") == 1
    assert purge(spark, str(archive), NOW + datetime.timedelta(days=30)) == 2 and not names(archive)


def test_no_place_and_no_files(spark, tmp_path):
    assert purge(spark, str(tmp_path / "nowhere"), NOW) == 0
    (tmp_path / "empty").mkdir()
    assert purge(spark, str(tmp_path / "empty"), NOW) == 0
    assert purge(spark, str(tmp_path / "empty")) == 0


def test_the_session_time_zone_does_not_matter(spark, archive):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert purge(spark, str(archive), NOW) == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_file_written_again_since_the_listing_stays(spark, archive, monkeypatch):
    listed = retention.list_files

    def then_written_again(*arguments):
        files = listed(*arguments).cache()
        files.count()
        put(archive, "old.json", 0, text="new\n")
        (archive / "BROKEN .json").unlink()
        return files

    monkeypatch.setattr(retention, "list_files", then_written_again)
    assert purge(spark, str(archive), NOW) == 1
    assert "old.json" in names(archive) and "deep/er/old.json" not in names(archive)


def test_times_through_the_file_system(spark, tmp_path):
    path = put(tmp_path, "a.json", 1)
    store = Store(spark, str(tmp_path))
    assert store.modified(str(path)) == milliseconds(NOW) - 60_000 == milliseconds(NOW.replace(tzinfo=datetime.UTC)) - 60_000
    store.set_modified(str(path), milliseconds(NOW))
    assert store.modified(str(path)) == milliseconds(NOW) and store.modified(str(tmp_path / "b")) is None
