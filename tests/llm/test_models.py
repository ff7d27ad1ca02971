"""Quality classifier, language model and personal data: held-out accuracy and brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_rows import ROWS, prose

from tidegauge.llm.language_model import discounts, language_model_scores
from tidegauge.llm.pii import personal_data, reliabilities
from tidegauge.llm.pii_spans import KINDS, base_and_failed, luhn
from tidegauge.llm.quality import THRESHOLD, good_documents, isotonic, quality_scores

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def remainder(doc_id, by):
    return zlib.crc32(str(doc_id).encode()) % by


def test_isotonic_regression_is_the_best_monotone_fit():
    r = random.Random(2)
    for _ in range(200):
        weight = np.array([r.randint(1, 4) for _ in range(6)], float)
        total = np.array([r.randint(0, int(w)) for w in weight], float)
        mean = total / weight
        # Max-min formula of the isotonic fit.
        want = [max(min(total[a : b + 1].sum() / weight[a : b + 1].sum() for b in range(i, 6)) for a in range(i + 1)) for i in range(6)]
        assert np.allclose(isotonic(weight, total), want), mean
    assert isotonic(np.array([0.0, 2, 0, 2, 0]), np.array([0.0, 0, 0, 2, 0])).tolist() == [0, 0, 0.5, 1, 1]


def test_held_out_documents_are_told_apart(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality_scores(docs, labels)
    assert scores.count() == docs.count()
    rows = scores.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and r["predicted"] == int(r["score"] >= THRESHOLD) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert {r["quality"] for r in held} == {0, 1}
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)


def test_quality_of_edge_cases(spark, edges, nothing):
    marks = [(i, i % 2) for i in range(1, 15)] + [(1, 0), (None, 1), (2, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = quality_scores(edges, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in ROWS)
    kept = good_documents(edges, labels)
    assert kept.columns == edges.columns and kept.count() == sum(r["score"] >= THRESHOLD for r in got)
    assert quality_scores(nothing, labels).count() == 0
    assert {r["score"] for r in quality_scores(edges, labels.limit(0)).collect()} == {0.5}


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute_model(rows):
    count, pairs = Counter(), Counter()
    for i, t in rows:
        if i is None or remainder(i, 7) != 2:
            w = words(t)
            count.update(w)
            pairs.update(zip(["<begin>", *w], w, strict=False))
    n, v = sum(count.values()), len(count)
    follows = Counter(w for _, w in pairs)

    def four(values):
        return [sum(x == k for x in values) for k in (1, 2, 3, 4)]

    cut, word_cut = discounts(four(pairs.values())), discounts(four(follows.values()))
    total, freed = Counter(), Counter()
    for (a, _), c in pairs.items():
        total[a] += c
        freed[a] += cut[min(c, 3) - 1]
    types = len(pairs)
    back = sum(word_cut[min(c, 3) - 1] for c in follows.values()) / types if types else 1.0

    def lower(w):
        f = follows.get(w, 0)
        return (max(f - word_cut[min(f, 3) - 1], 0) / types if f else 0) + back / (v + 1)

    def chance(a, w):
        c = pairs.get((a, w), 0)
        return ((c - cut[min(c, 3) - 1] if c else 0) + freed[a] * lower(w)) / total[a] if total[a] else lower(w)

    out = []
    for i, t in rows:
        w = words(t)
        base = sum(math.log10((count.get(x, 0) + 1) / (n + v + 1)) for x in w)
        score = sum(math.log10(chance(a, x)) for a, x in zip(["<begin>", *w], w, strict=False))
        out.append((i, i is not None and remainder(i, 7) == 2, len(w), sum(x in count for x in w), n, base, score))
    everything = sum(map(lower, count)) + lower("<unseen>")
    return out, everything


def close(got, want):
    def order(r):
        return (r[0] is None, r[0] or 0, r[2], round(r[5], 4))

    for g, w in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_language_model_of_edge_cases(edges, nothing):
    want, everything = brute_model(ROWS)
    assert everything == pytest.approx(1)
    close(language_model_scores(edges).select(COLUMNS).collect(), want)
    assert language_model_scores(nothing).count() == 0


def test_language_model_over_given_documents(spark, monkeypatch):
    monkeypatch.setattr("tidegauge.llm.language_model.HELD", 20_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want, everything = brute_model([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert everything == pytest.approx(1)
    got = language_model_scores(docs).select(COLUMNS).collect()
    close(got, want)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_nothing_to_train_on(frame):
    alone = next(i for i in range(100) if remainder(i, 7) == 2)
    (row,) = language_model_scores(frame([(alone, "a b")])).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert row["base_score"] == row["score"] == 0.0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub(r"\D", "", m)) <= 15),
}


def brute_base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, (p, ok)) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if ok(m[0])]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(5)
    parts = ["1", "2", "25", "300", "4242424242424242", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "a@b.co", "é", "\n", "12.3.4.5", "+1 (555) 010-9999"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        good = sorted(base_and_failed(text)[0], key=lambda s: (s.start, s.kind))
        assert [f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in good] == brute_base(text)


def test_long_runs_take_no_quadratic_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1 " * 70_000, "password" + " " * 200_000, "x1" * 100_000):
        base_and_failed(text)


def test_personal_data_of_edge_cases(frame, edges, nothing):
    rows = personal_data(edges).collect()
    assert len(rows) == len(ROWS)
    (row,) = [r for r in rows if r["doc_id"] == 16]
    assert (row["n_email"], row["n_phone"], row["n_ip"], row["n_card"]) == (1, 1, 1, 1)
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (4, 5, 11))
    assert personal_data(nothing).count() == 0
    assert {r["spans"] for r in personal_data(frame([(1, "plain"), (2, None)])).collect()} == {""}


def test_the_method_adds_spans_to_those_of_the_patterns(frame):
    r = random.Random(3)

    def filled(i):
        kind = i % 5
        secret = "AKIA" + "".join(r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(16))
        own = [f"mail jo{i}@mail{i}.example.com", f"call +1 (502) 555-{i:04d}", f"host 10.1.{i % 200}.7", f"aws key {secret}", "nothing here"][kind]
        return i, f"{prose(i, 8)} {own} {prose(i + 1, 8)}"

    rows = [filled(i) for i in range(200)]
    for row, (_, text) in zip(sorted(personal_data(frame(rows)).collect()), rows, strict=True):
        base, spans = brute_base(text), row["spans"].split(",") if row["spans"] else []
        assert row["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(spans)
        assert any(s.startswith("secret:") for s in spans) == ("AKIA" in text)


def test_reliable_labelers_weigh_more():
    # Two labelers that agree with each other, one that votes at random.
    code = lambda *v: sum(x * 3**i for i, x in enumerate([*v, 2, 2, 2]))
    counts = {(0, code(1, 1, x)): 400 for x in (0, 1)} | {(0, code(0, 0, x)): 400 for x in (0, 1)} | {(0, code(1, 0, 0)): 20, (0, code(0, 1, 1)): 20}
    share = reliabilities(counts)
    assert min(share[0, code(1, 1, x)] for x in (0, 1)) > 0.9 and max(share[0, code(0, 0, x)] for x in (0, 1)) < 0.1
