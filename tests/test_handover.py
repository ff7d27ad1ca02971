"""A running count that goes on with another number of state partitions."""

from __future__ import annotations

import pytest

from tidegauge import jobs
from tidegauge.operators.latest import read_parts
from tidegauge.schemas import WORD_COUNT
from tidegauge.streaming import read_counts, read_files, repartitioned_word_count, running_word_count, stored_counts


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def counted(df):
    return {r["word"]: r["count"] for r in df.collect()}


def state_partitions(spark, checkpoint):
    return {r[0] for r in spark.read.format("state-metadata").load(checkpoint).select("numPartitions").collect()}


def test_counts_go_on_from_2_to_8_to_3_partitions(spark, tmp_path):
    source = tmp_path / "in"
    first, second, third = (str(tmp_path / f"c{i}") for i in range(3))
    put(source, "one file.txt", "a b\n")
    put(source, "1.txt", "a c\n")
    running_word_count(spark, str(source), str(tmp_path / "t0"), first, max_files=1, partitions=2).awaitTermination()
    assert counted(stored_counts(spark, first)) == {"a": 2, "b": 1, "c": 1} and state_partitions(spark, first) == {2}
    assert read_files(spark, first).count() == 2

    def go_on(table, checkpoint, old, partitions):
        repartitioned_word_count(spark, str(source), table, checkpoint, old, partitions=partitions).awaitTermination()
        return counted(read_counts(spark, table))

    put(source, "2.txt", "a d\n")
    table = str(tmp_path / "t1")
    assert go_on(table, second, first, 8) == {"a": 3, "b": 1, "c": 1, "d": 1}
    assert state_partitions(spark, second) == {8}
    # It starts again without the checkpoint that it came from, and counts nothing twice.
    assert go_on(table, second, str(tmp_path / "gone"), 8) == {"a": 3, "b": 1, "c": 1, "d": 1}
    put(source, "3.txt", "d e\n")
    assert go_on(table, second, first, 8) == {"a": 3, "b": 1, "c": 1, "d": 2, "e": 1}
    # A later batch writes what it changed, and no more.
    parts = read_parts(spark, table, WORD_COUNT)
    last = parts.agg({"part": "max"}).first()[0]
    assert {r["word"] for r in parts.where(f"part = {last}").collect()} == {"d", "e"}
    put(source, "4.txt", "a\n")
    assert go_on(str(tmp_path / "t2"), third, second, 3) == {"a": 4, "b": 1, "c": 1, "d": 2, "e": 1}
    assert state_partitions(spark, third) == {3}


def test_files_that_a_broken_batch_has_seen_are_not_lost(spark, tmp_path):
    source, old = tmp_path / "in", tmp_path / "c0"
    put(source, "0.txt", "a\n")
    args = (spark, str(source), str(tmp_path / "t0"), str(old))
    running_word_count(*args, partitions=2).awaitTermination()
    put(source, "1.txt", "b\n")
    running_word_count(*args, partitions=2).awaitTermination()
    # The source has listed the second file, but its batch was never planned: as when the query dies in between.
    for log in ("offsets", "commits"):
        for name in ("1", ".1.crc"):
            (old / log / name).unlink()
    assert read_files(spark, str(old)).count() == 1


def test_a_batch_that_broke_off_and_an_empty_checkpoint_are_refused(spark, tmp_path):
    source, old = tmp_path / "in", tmp_path / "c0"
    put(source, "0.txt", "a\n")
    running_word_count(spark, str(source), str(tmp_path / "t0"), str(old), partitions=2).awaitTermination()
    (old / "commits" / "0").rename(tmp_path / "0")
    with pytest.raises(ValueError, match="no finished batch"):
        repartitioned_word_count(spark, str(source), str(tmp_path / "t1"), str(tmp_path / "c1"), str(old), partitions=3)
    (tmp_path / "0").rename(old / "commits" / "0")
    (old / "offsets" / "1").write_text((old / "offsets" / "0").read_text())
    with pytest.raises(ValueError, match="broke off"):
        repartitioned_word_count(spark, str(source), str(tmp_path / "t1"), str(tmp_path / "c1"), str(old), partitions=3)


def test_archived_files_are_not_read_again(spark, tmp_path):
    source, done = tmp_path / "in", tmp_path / "done"
    for i in range(4):
        put(source, f"{i}.txt", f"a w{i}\n")
    running_word_count(spark, str(source), str(tmp_path / "t0"), str(tmp_path / "c0"), max_files=1, partitions=2, archive=str(done)).awaitTermination()
    left = len(list(source.glob("*.txt")))
    assert left < 4
    put(source, "9.txt", "a\n")
    query = repartitioned_word_count(spark, str(source), str(tmp_path / "t1"), str(tmp_path / "c1"), str(tmp_path / "c0"), partitions=5)
    query.awaitTermination()
    assert counted(read_counts(spark, str(tmp_path / "t1"))) == {"a": 5, **{f"w{i}": 1 for i in range(4)}}


def test_job(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    put(tmp_path / "in", "0.txt", "a b a\n")
    source, old, new = (str(tmp_path / n) for n in ("in", "c0", "c1"))
    jobs.main(["count-words", "--source", source, "--checkpoint", old, "--table", str(tmp_path / "t0"), "--partitions", "2"])
    with pytest.raises(SystemExit):
        jobs.main(["count-words", "--source", source, "--checkpoint", new, "--continues", old])
    jobs.main(["count-words", "--source", source, "--checkpoint", new, "--table", str(tmp_path / "t1"), "--partitions", "3", "--continues", old])
    assert counted(read_counts(spark, str(tmp_path / "t1"))) == {"a": 2, "b": 1}
