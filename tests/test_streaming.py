from __future__ import annotations

import json

import pytest

from tidegauge import jobs
from tidegauge.operators.aggregates import totals
from tidegauge.operators.latest import read_parts, read_replacing
from tidegauge.operators.words import lines_of, word_counts
from tidegauge.plans.requests import LOG_KEY
from tidegauge.schemas import REQUEST_LOG, REQUEST_LOGS, SALES, SALES_STATS, WORD_COUNT
from tidegauge.sources import stream_json_lines
from tidegauge.streaming import console_word_count, read_counts, running_word_count, stream_log, stream_totals

TEXTS = ["a  b", "", " c ", "b a\nb"]


def counted(df):
    return {r["word"]: r["count"] for r in df.collect()}


def test_words_between_single_blanks(spark):
    lines = spark.createDataFrame([("a  b",), ("",), (None,), (" c ",)], "value STRING")
    assert counted(word_counts(lines)) == {"a": 1, "": 4, "b": 1, "c": 1}


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))


def batch_count(spark, texts):
    return counted(word_counts(lines_of(spark.createDataFrame([(t,) for t in texts], "text STRING"), "text")))


def test_stream_of_three_batches_equals_the_batch_count_and_reruns(spark, tmp_path):
    source, table, checkpoint = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "c")
    for i, text in enumerate(TEXTS[:3]):
        put(source, f"{i}.txt", [text])

    def run():
        query = running_word_count(spark, str(source), table, checkpoint, max_files=1, partitions=2)
        query.awaitTermination()
        return query

    assert len(run().recentProgress) >= 3
    assert counted(read_counts(spark, table)) == batch_count(spark, TEXTS[:3])
    run()
    assert counted(read_counts(spark, table)) == batch_count(spark, TEXTS[:3])
    put(source, "3.txt", [TEXTS[3]])
    run()
    assert counted(read_counts(spark, table)) == batch_count(spark, TEXTS)
    # The last batch wrote only the words it changed.
    parts = read_parts(spark, table, WORD_COUNT)
    last = parts.agg({"part": "max"}).first()[0]
    assert {r["word"] for r in parts.filter(f"part = {last}").collect()} <= {"a", "b"}


def test_carriage_returns_nulls_and_a_batch_run_again(spark, tmp_path):
    texts = ["a\rb", None, "c\r", "a b"]
    source, table = tmp_path / "in", str(tmp_path / "t")
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    df.where("value IS NOT NULL").coalesce(1).write.option("lineSep", "\n").text(str(source))
    running_word_count(spark, str(source), table, str(tmp_path / "c"), partitions=2).awaitTermination()
    want = batch_count(spark, texts)
    assert want == {"a\rb": 1, "c\r": 1, "a": 1, "b": 1}
    assert counted(read_counts(spark, table)) == want
    # A batch that is run again, as after a crash before its commit, writes its own part anew.
    running_word_count(spark, str(source), table, str(tmp_path / "c2"), partitions=2).awaitTermination()
    assert counted(read_counts(spark, table)) == want


def test_restart_empties_the_table_and_settings_survive(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "0.txt", ["a"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for run in range(2):
        running_word_count(
            spark, str(source), table, str(tmp_path / f"c{run}"), partitions=2, restart=True
        ).awaitTermination()
        assert counted(read_counts(spark, table)) == {"a": 1}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_console_form_in_memory(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "0.txt", TEXTS[:1])
    query = console_word_count(spark, str(source), str(tmp_path / "c"), sink="memory", name="counts", partitions=2)
    query.awaitTermination()
    assert counted(spark.table("counts")) == batch_count(spark, TEXTS[:1])


def test_console_form(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "0.txt", TEXTS[:1])
    console_word_count(spark, str(source), str(tmp_path / "c"), partitions=2).awaitTermination()


def sale(item, amount):
    return json.dumps({"item": item, "amount": amount, "ts": 1})


def test_sales_stream_loads_each_file_once(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "0.json", [sale("mouse", 50), "BROKEN", sale("screen", 100)])
    put(source, "1.json", [sale("mouse", 60)])

    def run():
        rows = stream_json_lines(spark, str(source), SALES, max_files=1).rows
        stream_totals(rows, table, str(tmp_path / "c")).awaitTermination()
        stored = totals(read_parts(spark, table, SALES_STATS), amount="total_amount")
        return {r["item"]: r["total_amount"] for r in stored.collect()}

    assert run() == {"mouse": 110.0, "screen": 100.0}
    assert run() == {"mouse": 110.0, "screen": 100.0}
    put(source, "2.json", [sale("mouse", 1)])
    assert run() == {"mouse": 111.0, "screen": 100.0}


def test_archived_source_files_are_not_loaded_again(spark, tmp_path):
    source, table, archive = tmp_path / "in", str(tmp_path / "t"), tmp_path / "done"
    for i in range(3):
        put(source, f"{i}.json", [sale("mouse", 1)])

    def run():
        rows = stream_json_lines(spark, str(source), SALES, max_files=1, archive=str(archive)).rows
        stream_totals(rows, table, str(tmp_path / "c")).awaitTermination()
        return [r["total_amount"] for r in totals(read_parts(spark, table, SALES_STATS), amount="total_amount").collect()]

    assert run() == [3.0]
    assert run() == [3.0]
    assert list(archive.rglob("*.json"))


def test_a_stream_keeps_its_rejects(spark, tmp_path):
    source, table, rejects = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "r")
    bad = [log_line(7, 1.0).replace("2024-05-01T12", "01/05/2024 12"), log_line(8, 1.0)[:-3], log_line(9, 1.0).replace('"2024-05-01T12:00:00"', "null")]
    put(source, "0.json", [log_line(t, 1.0) for t in range(5)] + bad)
    lines = stream_json_lines(spark, str(source), REQUEST_LOG).lines
    stream_log(lines, table, str(tmp_path / "c"), rejects=rejects).awaitTermination()
    stored = read_replacing(spark, table, REQUEST_LOGS, LOG_KEY)
    assert sorted(r["t"] for r in stored.collect()) == [*range(5)]
    kept = [r["value"] for r in spark.read.text(rejects).collect()]
    assert len(kept) == 3 and {json.loads(k)["t"] for k in kept if k.endswith("}")} == {7, 9}
    assert bad[1] in kept


def log_line(t, y):
    record = dict(timestamp="2024-05-01T12:00:00", t=t, hour=12, requests=50, size=100.0, y=y, y_lag1=0.0, drift_factor=0.1)
    return json.dumps(record)


def test_request_log_stream_keeps_the_last_load_of_a_record(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")

    def run():
        rows = stream_json_lines(spark, str(source), REQUEST_LOG).rows
        stream_log(rows, table, str(tmp_path / "c")).awaitTermination()
        stored = read_replacing(spark, table, REQUEST_LOGS, LOG_KEY, ["processed_at"])
        return {r["t"]: r["y"] for r in stored.collect()}

    put(source, "0.json", [log_line(t, 1.0) for t in range(5)])
    assert run() == {t: 1.0 for t in range(5)}
    put(source, "1.json", [log_line(t, 2.0) for t in range(3, 8)])
    assert run() == {t: 1.0 if t < 3 else 2.0 for t in range(8)}
    assert run() == {t: 1.0 if t < 3 else 2.0 for t in range(8)}


def test_jobs_run_from_the_command_line(spark, tmp_path, capsys):
    at = lambda name: str(tmp_path / name)
    put(tmp_path / "sales", "0.json", [sale("mouse", 50), sale("screen", 100), sale("mouse", 60)])
    put(tmp_path / "words", "0.txt", ["a b a"])
    put(tmp_path / "log", "0.json", [log_line(t, float(t % 7)) for t in range(125)])
    jobs.main(["load-sales", "--source", at("absent"), "--table", at("stats")])
    assert "no sales" in capsys.readouterr().out
    jobs.main(["load-sales", "--source", at("sales"), "--table", at("stats")])
    jobs.main(["stream-sales", "--source", at("sales"), "--table", at("stream"), "--checkpoint", at("c1")])
    jobs.main(["sales-trend", "--table", at("stats"), "--results", at("models")])
    jobs.main(["total-amount", "--source", at("sales"), "--table", at("total")])
    jobs.main(["count-words", "--source", at("words"), "--table", at("counts"), "--checkpoint", at("c2"), "--partitions", "2"])
    jobs.main(["load-requests", "--source", at("log"), "--table", at("logs"), "--checkpoint", at("c3")])
    jobs.main(["compact-requests", "--table", at("logs"), "--target", at("merged")])
    jobs.main(["load-requests", "--source", at("log"), "--table", at("days"), "--checkpoint", at("c5"), "--daily"])
    jobs.main(["merge-requests", "--table", at("days")])
    assert "loads merged: 1" in capsys.readouterr().out and spark.read.parquet(at("days/days")).count() == 125
    jobs.main(["evaluate-drift", "--source", at("log"), "--series", at("series"), "--metrics", at("metrics"), "--checkpoint", at("c4")])
    put(tmp_path / "sales", "1.json", ["BROKEN"])
    jobs.main(["retain-files", "--source", at("sales"), "--dry-run"])
    jobs.main(["retain-files", "--source", at("sales")])
    assert "files deleted: 0" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.main(["load-requests", "--source", at("log"), "--table", at("logs"), "--checkpoint", at("x"), "--archive", at("old")])
    jobs.main(["evaluate-drift", "--series", at("no-series"), "--metrics", at("no-metrics")])
    assert "no series" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        jobs.main(["evaluate-drift", "--source", at("log"), "--series", at("series"), "--metrics", at("metrics")])
    read = lambda name: spark.read.parquet(at(name))
    assert {r["item"]: r["total_amount"] for r in read("stats").collect()} == {"mouse": 110.0, "screen": 100.0}
    assert read("stream").count() == 2 and read("models").count() == 1
    assert read("total").first()[0] == 210
    assert counted(read_counts(spark, at("counts"))) == {"a": 2, "b": 1}
    assert read("merged").count() == 125
    assert sorted(r["t_end"] for r in read("metrics").collect()) == [100, 120]
