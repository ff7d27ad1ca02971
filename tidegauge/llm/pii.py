"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a classifier decides.

Pattern, checksum, gazetteer and context labelers vote on candidate spans of every whole text. How
often each combination of votes occurs per kind is counted in Spark; there are at most ``3**6`` a kind, so
the driver's expectation-maximisation sees a table of bounded size. It estimates how reliable each
labeler is for each kind and how likely each combination is personal data. With these as soft labels
a logistic span classifier is trained by Newton steps, whose sums are again made in Spark. Spans
of the fixed base patterns are always returned; of other candidates, those the classifier admits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.kernel import pieces
from tidegauge.llm.pii_spans import KINDS, LABELERS, WIDTH, base_and_failed, described, more_candidates
from tidegauge.llm.quality import summed
from tidegauge.llm.store import bounded, stored

ROUNDS = 40
NEWTON_STEPS = 8
RIDGE = 1.0
#: A candidate is admitted from this probability on.
ADMITTED = 0.5

_FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans array<struct<kind:int,start:long,end:long,base:boolean,votes:int,numbers:array<float>>>"


def _find(batches):
    for batch in pieces(batches, 1):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            good, bad = base_and_failed(text)
            good.sort(key=lambda s: (s.start, s.kind))
            spans = [(s, True) for s in good] + [(s, False) for s in more_candidates(text, good, bad)]
            listed = []
            for span, base in spans:
                votes, numbers = described(text, span, base)
                code = sum(v * 3**i for i, v in enumerate(votes))
                listed.append({"kind": span.kind, "start": span.start, "end": span.end, "base": base, "votes": code, "numbers": numbers})
            counts = [sum(s.kind == k for s in good) for k in range(4)]
            text_of = ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in good)
            rows.append((doc_id, *counts, hashlib.sha256(text_of.encode()).hexdigest(), listed))
        names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)], names)


_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("votes", pa.int32()), ("numbers", pa.list_(pa.float32()))])
_TYPES = [pa.int64()] * 5 + [pa.string(), pa.list_(_SPAN)]


def reliabilities(counts: dict[tuple[int, int], int]) -> dict[tuple[int, int], float]:
    """Probability that spans of a kind with these votes are personal data, for every combination counted.

    Labelers are taken to vote independently given the truth, with their own reliabilities per kind.
    """
    out: dict[tuple[int, int], float] = {}
    for kind in {k for k, _ in counts}:
        codes = [v for k, v in counts if k == kind]
        votes = np.array([[v // 3**i % 3 for i in range(LABELERS)] for v in codes])
        weight = np.array([counts[kind, v] for v in codes], float)
        share = ((votes == 1).sum(1) + 0.5) / ((votes < 2).sum(1) + 1)
        for _ in range(ROUNDS):
            prior = np.clip((weight * share).sum() / weight.sum(), 0.02, 0.98)
            logit = np.full(len(codes), np.log(prior / (1 - prior)))
            for i in range(LABELERS):
                table = [np.array([(weight * p * (votes[:, i] == v)).sum() for v in range(3)]) for p in (share, 1 - share)]
                # A labeler is thought better than chance before anything is counted.
                yes, no = table[0] + [0.5, 2, 1], table[1] + [2, 0.5, 1]
                logit += np.log(yes / yes.sum())[votes[:, i]] - np.log(no / no.sum())[votes[:, i]]
            share = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        out |= {(kind, v): float(p) for v, p in zip(codes, share, strict=True)}
    return out


def classifier(spans: DataFrame, labels: dict[tuple[int, int], float]) -> np.ndarray:
    """Weights of a logistic regression on the spans' numbers, for soft labels by kind and votes."""
    size = WIDTH + 1
    weights = np.zeros(size)

    def step(at: np.ndarray) -> np.ndarray:
        def equations(batch) -> np.ndarray:
            x = np.asarray(batch.column("numbers").flatten(), float).reshape(-1, WIDTH)
            x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
            y = np.array([labels[k] for k in zip(batch.column("kind").to_pylist(), batch.column("votes").to_pylist(), strict=True)])
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            return np.concatenate((((x.T * (p * (1 - p))) @ x).ravel(), x.T @ (y - p)))

        sums = summed(spans, equations, size * size + size)
        slope = sums[size * size :] - RIDGE * at
        return at + np.linalg.solve(sums[: size * size].reshape(size, size) + RIDGE * np.eye(size), slope)

    for _ in range(NEWTON_STEPS):
        new = step(weights)
        moved, weights = np.abs(new - weights).max(), new
        if moved < 1e-3:
            break
    return weights


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts ``n_email`` ``n_ip`` ``n_card`` ``n_phone``, ``base_sha256``, ``spans`` for every row of ``docs(doc_id, text)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. Null and empty
    texts have none. Rows without an id and rows that repeat are judged each. Other columns are not
    read. An empty table gives an empty result; without any candidate nothing is trained.
    """
    found = stored(bounded(docs.select("doc_id", "text")).mapInArrow(_find, _FOUND), "spans")
    spans = found.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.numbers")
    counts = {(r["kind"], r["votes"]): r["n"] for r in spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights = classifier(spans, reliabilities(counts)) if counts else np.zeros(WIDTH + 1)

    def decide(batches):
        for batch in batches:
            out = []
            for spans in batch.column("spans").to_pylist():
                kept = []
                for s in spans:
                    odds = float(np.dot(weights[:-1], s["numbers"]) + weights[-1]) if not s["base"] else 1.0
                    if s["base"] or 1 / (1 + np.exp(-np.clip(odds, -30, 30))) >= ADMITTED:
                        kept.append((s["start"], s["kind"], s["end"]))
                out.append(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(kept)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(6)), pa.array(out, pa.string())], [*batch.schema.names[:6], "spans"])

    return found.mapInArrow(decide, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
