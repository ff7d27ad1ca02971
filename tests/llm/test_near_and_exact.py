"""Near and exact duplicates, repeated substrings and components against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import uuid
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from llm_rows import ROWS, edited, prose
from pyspark.sql import functions as F

from tidegauge.llm import exact_dedup, near_dedup, substring_dedup
from tidegauge.llm.components import components
from tidegauge.llm.exact_dedup import exact_duplicates, first_of_copies, hot_hashes, normalised_rows, stretches
from tidegauge.llm.near_dedup import near_duplicates
from tidegauge.llm.substring_dedup import LENGTH, repeated_substrings

PASSAGE_ALL = prose(77, 40)
KNOWN = [(i, t) for i, t in ROWS if i is not None]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def brute_near(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    links = []
    for (a, x), (b, y) in combinations(sets, 2):
        shared = len(x & y)
        if x and y and 100 * shared >= percent * (len(x) + len(y) - shared):
            links.append((a, b))
    return smallest_reachable({i for i, _ in rows}, links)


def test_near_duplicates_of_edge_cases(edges):
    got = near_duplicates(edges, 85).collect()
    assert len(got) == len(ROWS)
    root = brute_near(KNOWN, 85)
    want = Counter((i, len(shingles(t)), root[i] if i is not None else None, i is None or root[i] == i) for i, t in ROWS)
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_of_groups_at_the_threshold(frame, percent, monkeypatch):
    # Groups larger than a block, of copies on both sides of the threshold, some linked only in chains.
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 4)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows, i = [], 0
    for base in range(3):
        for k in range(40):
            i += 1
            rows.append((i, edited(prose(base, 120), (0.0, 0.01, 0.02, 0.03)[k % 4], 1000 * base + k)))
    rows += [(i + 1 + k, prose(50 + k, 30)) for k in range(20)]
    random.Random(0).shuffle(rows)
    root = brute_near(rows, percent)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(rows), percent).collect()}
    assert got == root
    assert 20 < len(set(root.values())) < len(rows)


def test_near_duplicates_of_nothing(nothing):
    assert near_duplicates(nothing).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert near_duplicates(nothing).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    r = random.Random(4)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (301, 300)]
    links += [(r.randint(400, 460), r.randint(400, 460)) for _ in range(50)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == smallest_reachable(nodes, [(a, b) for a, b in links if a != b])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_duplicates_of_edge_cases(edges):
    got = exact_duplicates(edges).collect()
    groups: dict = {}
    for i, t in ROWS:
        groups.setdefault(normalised(t), []).append(i)
    digest = {hashlib.sha256(n.encode()).hexdigest(): ids for n, ids in groups.items()}
    assert len(got) == len(ROWS)
    for row in got:
        ids = digest[row["text_sha256"]]
        assert row["doc_id"] in ids and row["group_size"] == len(ids)
        assert row["keep_id"] == min((i for i in ids if i is not None), default=None)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept) == set(digest) and set(kept.values()) == {1}
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_first_of_copies_keeps_whole_rows(edges, nothing):
    kept = first_of_copies(edges)
    assert kept.columns == edges.columns
    rows = kept.collect()
    assert Counter(normalised(r["text"]) for r in rows) == Counter({normalised(t) for _, t in ROWS})
    assert {tuple(r) for r in rows} <= {tuple(r) for r in edges.collect()}
    assert first_of_copies(nothing).count() == 0 and exact_duplicates(nothing).count() == 0


def test_texts_are_shuffled_once_and_no_python_runs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = stretches(normalised_rows(docs, []), [])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning(head" in plan and "Window" in plan
    assert not re.search("Python|Arrow|Pandas", plan)


def test_neighbours_find_all_copies_outside_hot_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.unionByName(docs.limit(1).crossJoin(spark.range(400)).drop("id"))
    hot = hot_hashes(docs)
    assert 1 <= len(hot) < 8
    seen = stretches(normalised_rows(docs, [], hot), [])
    texts = Counter(re.sub(r"[ \t\n\x0b\f\r]+", " ", r["text"] or "") for r in docs.collect())
    cold = seen.where("NOT hot AND place = 1").collect()
    assert Counter(r["size"] for r in cold) == Counter(n for n in texts.values() if n < 400)
    # The hot text lies in several stretches of bounded size, and only their first rows keep it.
    lots = seen.where("hot").collect()
    assert len(lots) == max(texts.values()) and len({r["stretch"] for r in lots}) == sum(r["norm"] is not None for r in lots)
    assert all(r["norm"] is None for r in cold)


def test_hot_texts_of_one_hash_are_compared_in_full(frame, spark, monkeypatch):
    # All texts get one hash: stretches and heads must still tell them apart.
    rows = [(k, ("one text", "another", "a third\ttext")[k % 3]) for k in range(300)]
    whole = exact_dedup.hashed
    monkeypatch.setattr(exact_dedup, "hashed", lambda docs, carried: whole(docs, carried).withColumn("hash", F.lit(7).cast("long")))
    got = exact_duplicates(frame(rows)).collect()
    assert {(r["doc_id"] % 3, r["keep_id"], r["group_size"]) for r in got} == {(0, 0, 100), (1, 1, 100), (2, 2, 100)}
    assert sorted(r["doc_id"] for r in got if r["kept"]) == [0, 1, 2]
    assert sorted(r["doc_id"] for r in first_of_copies(frame(rows)).collect()) == [0, 1, 2]


def test_a_hot_group_of_copies(frame):
    got = exact_duplicates(frame([(i, "the same text") for i in range(500, 0, -1)] + [(501, "another")])).collect()
    assert Counter((r["keep_id"], r["group_size"], r["kept"]) for r in got) == {(1, 500, True): 1, (1, 500, False): 499, (501, 1, True): 1}


def brute_substrings(rows):
    first: dict = {}
    for i, t in rows:
        data = (t or "").encode()
        if i is not None:
            for k in range(len(data) - LENGTH + 1):
                part = data[k : k + LENGTH]
                first[part] = min(first.get(part, i), i)
    out = Counter()
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - LENGTH + 1):
            if i is not None and first[data[k : k + LENGTH]] < i:
                gone[k : k + LENGTH] = b"\1" * LENGTH
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i, len(data), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest()] += 1
    return out


def test_repeated_substrings_of_edge_cases(edges, nothing):
    assert Counter(map(tuple, repeated_substrings(edges).collect())) == brute_substrings(ROWS)
    assert repeated_substrings(nothing).count() == 0


def test_repeated_substrings_of_tangled_texts(frame):
    r = random.Random(9)
    parts = [prose(k, 20) for k in range(6)] + ["x" * 120, "ab" * 60, "é" * 40]
    rows = [(i, "".join(p[r.randint(0, 30) : r.randint(60, 130)] for p in r.choices(parts, k=r.randint(1, 5)))) for i in range(60)]
    rows += [(100 + k, PASSAGE_ALL) for k in range(30)]
    assert Counter(map(tuple, repeated_substrings(frame(rows)).collect())) == brute_substrings(rows)


def test_tasks_may_read_other_portions_in_every_pass(frame, spark, monkeypatch):
    portions = iter(["128m", "3k", "20k", "1k", "128m", "5k"])
    folder, key = substring_dedup.fresh_folder, "spark.sql.files.maxPartitionBytes"

    def other_portions(*arguments):
        spark.conf.set(key, next(portions))
        return folder(*arguments)

    monkeypatch.setattr(substring_dedup, "fresh_folder", other_portions)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        r = random.Random(3)
        passages = [prose(k, 15) for k in range(40)]
        rows = [(i, f"{prose(100 + i, 30)} {r.choice(passages)} {prose(500 + i, 30)}") for i in range(300)]
        result = repeated_substrings(frame(rows))
        spark.conf.set(key, next(portions))
        assert result.rdd.getNumPartitions() > 10
        assert Counter(map(tuple, result.collect())) == brute_substrings(rows)
    finally:
        spark.conf.unset(key)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("hot", [1, 300])
def test_keys_with_many_windows_are_taken_apart(frame, edges, hot, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", hot, raising=False)
    monkeypatch.setattr(substring_dedup, "OFTEN", 1, raising=False)
    monkeypatch.setattr(substring_dedup, "GATHERED", 100, raising=False)
    assert Counter(map(tuple, repeated_substrings(edges).collect())) == brute_substrings(ROWS)
    r = random.Random(9)
    parts = [prose(k, 20) for k in range(6)] + ["x" * 120, "ab" * 60, "é" * 40]
    rows = [(i, "".join(p[r.randint(0, 30) : r.randint(60, 130)] for p in r.choices(parts, k=r.randint(1, 5)))) for i in range(60)]
    assert Counter(map(tuple, repeated_substrings(frame(rows)).collect())) == brute_substrings(rows)


def test_a_passage_in_every_document_does_not_gather_in_one_share(frame, spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT", 1000, raising=False)
    least_ids = substring_dedup._least_ids
    folder = substring_dedup.fresh_folder(spark, "met")

    def counted(table):
        (Path(folder.removeprefix("file:")) / f"{uuid.uuid4().hex}").write_text(str(sum(len(k) // 8 for k in table["keys"].to_pylist())))
        return least_ids(table)

    monkeypatch.setattr(substring_dedup, "_least_ids", counted)
    Path(folder.removeprefix("file:")).mkdir(parents=True, exist_ok=True)
    rows = [(i, f"{prose(20_000 + i, 20)} {PASSAGE_ALL[:300]} {prose(40_000 + i, 20)}") for i in range(1500)]
    assert Counter(map(tuple, repeated_substrings(frame(rows)).collect())) == brute_substrings(rows)
    met = [int(f.read_text()) for f in Path(folder.removeprefix("file:")).iterdir()]
    shares = substring_dedup.SHARES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert met and max(met) < max(1000, 4 * sum(met) / shares), (max(met), sum(met), len(met))


def test_documents_with_several_texts_have_the_links_of_all(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL_BUCKET", 2)
    texts = [edited(prose(1, 120), 0.02, k) for k in range(30)]
    rows = [(k // 2, t) for k, t in enumerate(texts)] + [(100 + k, edited(prose(2, 120), 0.02, k)) for k in range(20)] + [(3, prose(2, 120))]
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for (a, x), (b, y) in combinations(sets, 2) if a != b and 100 * len(x & y) >= 80 * len(x | y)]
    root = smallest_reachable({i for i, _ in rows}, links)
    got = near_duplicates(frame(rows), 80).collect()
    assert len(got) == len(rows) and all(r["component_id"] == root[r["doc_id"]] for r in got)


def test_an_id_links_the_equal_sets_of_all_its_texts(frame):
    a, b, c, d = (prose(60 + k, 30) for k in range(4))
    rows = [(3, a), (7, a), (7, b), (9, b), (20, c), (21, c), (22, c), (22, d), (23, d), (19, d), (30, prose(70, 30)), (None, a), (None, b)]
    links = [(i, j) for (i, x), (j, y) in combinations(rows, 2) if i is not None and j is not None and i != j and shingles(x) == shingles(y)]
    root = smallest_reachable({i for i, _ in rows if i is not None}, links)
    got = near_duplicates(frame(rows), 80).collect()
    assert len(got) == len(rows) and all(r["component_id"] == root.get(r["doc_id"]) for r in got)
    assert {r["doc_id"] for r in got if r["kept"]} == {3, 19, 30, None}
