"""Decontamination, licence scan, the pipeline's stages, and the registered queries."""

from __future__ import annotations

import os
import random
import re
import subprocess
import sys
import time
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_rows import ROWS, prose

from tidegauge.llm import decontamination, licenses
from tidegauge.llm.decontamination import LEAST_SHARE, LEAST_WORDS, MASKS, SHORTEST, contamination, decontaminated, overlap, whole_masks
from tidegauge.llm.kernel import slices, word_hashes
from tidegauge.llm.licenses import MIT, canonical, license_scan
from tidegauge.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

ROOT = Path(__file__).resolve().parents[2]
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, prose(500 + i, 30)) for i in range(5)] + [(5, prose(505, 8)), (6, "too short"), (7, None), (None, prose(507, 30)), (8, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_overlap_is_the_longest_stretch_with_the_share():
    r = random.Random(6)
    for _ in range(300):
        agree = [float(r.random() < 0.7) for _ in range(r.randint(1, 30))]
        least = r.randint(1, 10)
        good = [(b - a, sum(agree[a:b])) for a in range(len(agree)) for b in range(a + least, len(agree) + 1) if sum(agree[a:b]) >= LEAST_SHARE * (b - a) - 1e-9]
        import numpy as np

        got = overlap(np.array(agree), least)
        assert (got > 0) == bool(good)
        if good:
            assert got in {s for n, s in good if n == max(good)[0]}


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_passages_with_substituted_words_are_found(frame, items, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", block)
    rows, want = [], {}
    for k in range(40):
        passage = prose(500 + k % 5, 30).split(" ")
        for place in range(k % 3, 30, (100, 11, 7)[k % 3]):
            passage[place] = f"other{k}"
        rows.append((k, f"{prose(k, 50)}\n{' '.join(passage).upper() if k % 2 else ' '.join(passage)} {prose(k + 1, 50)}"))
        want[k] = [k % 5]
    rows += [(100, prose(505, 8)), (101, "before " + prose(505, 8)), (102, " ".join(prose(500, 30).split(" ")[:9])), (103, "too short"), *[(200 + k, prose(900 + k, 300)) for k in range(30)]]
    want |= {100: [5], 101: [5]}
    got = {r["doc_id"]: r["item_ids"] for r in contamination(frame(rows), items).collect()}
    assert {k: v for k, v in got.items() if v} == want and len(got) == len(rows)
    kept = decontaminated(frame(rows), items)
    assert {r["doc_id"] for r in kept.collect()} == set(got) - set(want) and kept.columns == frame([]).columns


@pytest.mark.parametrize("n", range(SHORTEST, 2 * LEAST_WORDS))
def test_every_placement_of_substituted_words_has_a_hit(n):
    differ = np.array([sum(1 << i for i in c) for c in combinations(range(n), int(n * (1 - LEAST_SHARE) + 1e-9))])
    hit = np.zeros(len(differ), bool)
    for mask in MASKS if n >= LEAST_WORDS else whole_masks(n):
        for place in range(n - len(mask) + 1):
            hit |= (differ >> place) & int(mask[::-1], 2) == 0
    assert hit.all()


def test_overlaps_with_random_substitutions_equal_brute_force(frame, spark):
    r = random.Random(12)
    items = {i: prose(3000 + i, r.choice([*range(6, 17), 20, 25, 30])).split(" ") for i in range(60)}
    docs = {}
    for k in range(600):
        own = items[k % 60]
        length = r.randint(min(LEAST_WORDS, len(own)), len(own))
        part = own[(low := r.randint(0, len(own) - length)) : low + length]
        for place in r.sample(range(length), int(length * r.choice((0.2, 0.2, 0.1, 0.25, 0.3)))):
            part = [*part[:place], f"other{k}", *part[place + 1 :]]
        docs[k] = [*prose(5000 + k, r.randint(0, 5)).split(" "), *part, *prose(7000 + k, r.randint(0, 5)).split(" ")]
    docs = {k: [w for w in d if w] for k, d in docs.items()}
    want = {}
    for k, words in docs.items():
        want[k] = []
        for i, own in items.items():
            for diagonal in range(1 - len(own), len(words)):
                low, high = max(diagonal, 0), min(diagonal + len(own), len(words))
                agree = [words[p] == own[p - diagonal] for p in range(low, high)]
                least = min(LEAST_WORDS, len(own))
                if any(sum(agree[a:b]) >= LEAST_SHARE * (b - a) - 1e-9 for a in range(len(agree)) for b in range(a + least, len(agree) + 1)):
                    want[k].append(i)
                    break
    found = contamination(frame([(k, " ".join(d)) for k, d in docs.items()]), spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string"))
    assert {row["doc_id"]: row["item_ids"] for row in found.collect()} == want
    assert 200 < sum(map(bool, want.values())) < 600


def _overlapped(words, own):
    """By brute force: the rule on every diagonal."""
    least = min(LEAST_WORDS, len(own))
    for diagonal in range(1 - len(own), len(words)):
        low, high = max(diagonal, 0), min(diagonal + len(own), len(words))
        agree = [words[p] == own[p - diagonal] for p in range(low, high)]
        if any(5 * sum(agree[a:b]) >= 4 * (b - a) for a in range(len(agree)) for b in range(a + least, len(agree) + 1)):
            return True
    return False


@pytest.mark.parametrize("block", [40, 1_000_000])
def test_repeated_words_and_short_items_equal_brute_force(frame, spark, block, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", block)
    r = random.Random(31)
    items = {i: [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(1, 18))] for i in range(50)}
    docs = {k: [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(0, 25))] for k in range(80)}
    found = contamination(frame([(k, " ".join(d)) for k, d in docs.items()]), spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string").repartition(2))
    for row in found.collect():
        over = [i for i, own in items.items() if _overlapped(docs[row["doc_id"]], own)]
        assert row["item_ids"] == [i for i in over if len(items[i]) >= SHORTEST]
        assert row["short_item_ids"] == [i for i in over if len(items[i]) < SHORTEST]
        assert row["contaminated"] == bool(row["item_ids"])


def test_short_items_alone_take_no_document_away(frame, spark):
    benchmark = spark.createDataFrame([(1, "too short"), (2, "yes")], "item_id long, text string")
    docs = frame([(1, "this is TOO short"), (2, "too long, not short"), (3, "yes yes")])
    assert [r["short_item_ids"] for r in contamination(docs, benchmark).orderBy("doc_id").collect()] == [[1], [], [2]]
    assert decontaminated(docs, benchmark).count() == 3


def test_a_run_of_one_word_takes_time_in_proportion():
    own = word_hashes(next(slices(pa.array(["a"]))))[1]
    seeds = decontamination.block_of([1, 2, 3, 4], [np.repeat(own, n) for n in (60, 70, 80, 2000)])
    blocks = [decontamination.Seeds(np.concatenate([np.ascontiguousarray(a).view(np.uint8) for a in seeds]))]
    start = time.monotonic()
    found = list(decontamination._found(blocks, pa.array(["a " * 2000])))
    assert found == [({1: 60, 2: 70, 3: 80, 4: 2000}, set())] and time.monotonic() - start < 2


def test_the_benchmark_does_not_pass_the_driver(frame, spark):
    benchmark = spark.createDataFrame([(i, prose(500 + i, 30)) for i in range(20)], "item_id long, text string").repartition(4)
    blocks = decontamination.seed_blocks(benchmark)
    assert 1 <= len(blocks.names) <= 4 and sum(len(seeds.ids) for seeds in blocks) == 20


def test_decontamination_of_edge_cases(edges, nothing, items):
    assert sum(r["contaminated"] for r in contamination(edges, items).collect()) == 0
    assert contamination(edges, items.limit(0)).count() == decontaminated(edges, items.limit(0)).count() == len(ROWS)
    assert contamination(nothing, items).count() == decontaminated(nothing, items).count() == 0


def test_canonical_texts():
    assert canonical("Copyright (c) 2020 Jo\n# The LICENCE, sub-license!\n(c) me") == "the license sublicense"
    assert canonical(None) == canonical(" ,;!\n") == ""
    commented = "/*\n" + "\n".join(f" * {line}" for line in MIT.splitlines()) + "\n */"
    assert canonical(commented) == canonical(f"Copyright 2001 A B\n\n{MIT.lower()}")


def test_licences_and_notices(frame, edges, nothing):
    rows = [
        (1, f"MIT License\n\nCopyright (c) 2019 Jo Doe\n\n{MIT.replace('sublicense', 'sublicence')}"),
        (2, MIT + " extra"),
        (3, "Some prose.\nLicensed under the Apache License, Version 2.0.\nRELEASED UNDER THE MIT LICENCE\nmore"),
        (4, "Licensed under the Apache License, Version 2.0. and more prose on the line"),
    ]
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in license_scan(frame(rows)).collect()}
    assert got == {1: ("MIT", ""), 2: (None, ""), 3: (None, "Apache-2.0,MIT"), 4: (None, "")}
    rows = license_scan(edges).collect()
    assert len(rows) == len(ROWS) and all(r["license"] is None and r["notices"] == "" for r in rows)
    assert license_scan(nothing).count() == 0


@pytest.mark.parametrize("cues", [0, 50])
def test_notices_of_a_caller_need_no_certain_word(frame, spark, cues, monkeypatch):
    monkeypatch.setattr(licenses, "CUES", cues, raising=False)
    known = [("GPL-3.0", "Released under GPL v3", False), ("Free", "Honour the organisation", False), ("Nothing", "All rights reserved", False)]
    rows = [(1, "Prose.\n# released under GPL V3.\nmore"), (2, "honor the Organization"), (3, "Honour, the organisation!"), (4, "released under another"), (5, "All rights reserved")]
    got = license_scan(frame(rows), spark.createDataFrame(known, "license string, text string, whole boolean")).collect()
    assert {r["doc_id"]: r["notices"] for r in got} == {1: "GPL-3.0", 2: "Free", 3: "Free", 4: "", 5: ""}


def test_digests_are_those_of_whole_texts(frame):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0"}
    if not all((folder / f).exists() for f in files):
        pytest.skip("no licence texts on this machine")
    rows = [(i, (folder / f).read_text().upper().replace("\n", "\r\n")) for i, f in enumerate(files)]
    got = {r["doc_id"]: r["license"] for r in license_scan(frame([*rows, (9, rows[0][1] + " more")])).collect()}
    assert got == {**dict(enumerate(files.values())), 9: None}


def test_notices_in_lines_of_any_length(frame):
    line = "-" * 100_000 + " Licensed under the MIT License. " + "*" * 100_000
    assert [r["notices"] for r in license_scan(frame([(1, f"prose\n{line}\nprose")])).collect()] == ["MIT"]


def test_long_texts_take_time_in_proportion(frame):
    rows = [(1, "\n" * 1_000_000), (2, "-" * 1_000_000), (3, " *\n" * 300_000 + MIT), (4, "(" * 500_000 + "c)" * 200_000)]
    started = time.monotonic()
    assert {r["doc_id"]: r["license"] for r in license_scan(frame(rows)).collect()} == {1: None, 2: None, 3: "MIT", 4: None}
    assert time.monotonic() - started < 60


@pytest.mark.parametrize("name", ["op10_license_scan", "op11_spelling_variants"])
def test_workers_get_the_package_before_anything_runs_there(name, tmp_path):
    """Each query as the first of an application that starts in another folder."""
    script = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
import os; os.chdir({str(tmp_path)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
import tidegauge.llm.queries as q
sent = []
send = spark.sparkContext.addPyFile
from tidegauge.llm import store
import pyspark.sql.classic.dataframe as classic
ship = store.ship_code
def seen(spark): sent.append(1); ship(spark)
store.ship_code = seen
for method in ("mapInArrow", "mapInPandas"):
    run = getattr(classic.DataFrame, method)
    def checked(self, *a, run=run, **k):
        assert sent, "a Python worker before the package was sent"
        return run(self, *a, **k)
    setattr(classic.DataFrame, method, checked)
print("rows", q.QUERIES[{name!r}](spark, {SMALL!r}).count())
"""
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300, cwd=tmp_path, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "rows " in done.stdout, done.stderr[-2000:]


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "exact_dedup", "minhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    left = [texts_of(docs)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "best_fit_packing":
            assert out.columns == docs.columns, name
            docs = corpus_pipeline.stored(out, name)
            left.append(texts_of(docs))
            assert left[-1].items() <= left[-2].items()
    start, good, single, apart, clean = left
    wrong = [i for i, q in labels.items() if i in start and (i in good) != bool(q)]
    assert len(wrong) <= 0.05 * len(labels)
    flat = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in good.items()}
    first: dict = {}
    for i in sorted(flat):
        first.setdefault(flat[i], i)
    assert set(single) == set(first.values())

    from test_near_and_exact import brute_near

    root = brute_near(list(single.items()), 80)
    assert set(apart) == {i for i, low in root.items() if i == low}
    passages = [re.findall(r"\S+", r["text"].lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = {tuple(p[k : k + 13]) for p in passages for k in range(len(p) - 12)}
    for i, t in apart.items():
        w = re.findall(r"\S+", t.lower())
        if any(tuple(w[k : k + 13]) in grams for k in range(len(w) - 12)):
            assert i not in clean
    assert len(apart) - len(clean) < 0.1 * len(apart)
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == set(clean)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").distinct().collect()} == set(clean)


def test_every_stage_handles_edge_cases(spark, edges, nothing, tmp_path):
    spark.createDataFrame([(i, i % 2) for i in range(1, 17)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edges, nothing):
        before = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, str(tmp_path))
            assert out.count() <= before + 50, name
            if name != "best_fit_packing":
                assert out.columns == docs.columns, name
                docs = corpus_pipeline.stored(out, name)
        assert before or not out.count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    con.execute(ORACLES[name])
    columns = [d[0] for d in con.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(con.fetchall())


def test_one_query_for_each_operator():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()
