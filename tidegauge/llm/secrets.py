"""Secrets confirmed by their structure.

Candidates are runs of base64 or hex characters, dotted tokens and armoured blocks. Each is decoded, and
reported only if what it holds is the encoding of a private key whose nested lengths fit to the last
byte, or a token whose header names its algorithm and whose signature has that algorithm's length; see
`key_encodings`. Content that is base64 of such text, as in configuration files, is decoded once more. Spans of three
fixed patterns are always returned beside them. One scan; a document's work grows with its length.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.kernel import pieces
from tidegauge.llm.key_encodings import armoured_keys, decoded, is_private_key, is_signed_token
from tidegauge.llm.store import bounded

BASE_KINDS = ("assign", "access", "hex")
#: Kinds that are confirmed by decoding: armoured blocks, base64 or hex of a key, signed tokens, base64 of one of these.
KINDS = (*BASE_KINDS, "armour", "key", "token", "wrapped")

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: One of these is in every assignment, whatever its case.
_ASSIGNED = (b"password", b"passwd", b"secret", b"token", b"api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: The shortest key encoding, in base64 characters: a curve's key of 32 bytes in its shortest form.
LEAST_ENCODED = 48
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]*(?:\.[A-Za-z0-9_-]*){2,4}")

_HEX, _ENCODED = np.zeros(256, bool), np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_ENCODED[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
_HEX_PAIRS = re.compile(r"(?:[0-9a-f]{2})+|(?:[0-9A-F]{2})+")

Span = tuple[int, int, int]


def _runs(member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the maximal runs of true places that are long enough."""
    edge = np.flatnonzero(np.diff(member, prepend=False, append=False))
    starts, ends = edge[0::2], edge[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(text: str, raw: bytes, data: np.ndarray, place: np.ndarray | None) -> list[Span]:
    """Matches of the fixed patterns; ``place`` has the code point of each byte, None where they are the same."""
    found = []
    lowered = raw.lower()
    if any(word in lowered for word in _ASSIGNED):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGNED]
    if b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    starts, ends = _runs(_HEX[data], LEAST_HEX)
    if place is not None:
        starts, ends = place[starts], place[ends]
    return found + [(a, 2, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _key_in(run: str) -> bool:
    """Whether the run is the base64 or hex of a private key."""
    raw = decoded(run) if run[0] in "Mb" else None
    if raw is not None and is_private_key(raw):
        return True
    # A sequence's or the OpenSSH mark's first byte.
    return run[:2] in ("30", "6f", "6F") and _HEX_PAIRS.fullmatch(run) is not None and is_private_key(bytes.fromhex(run))


def _wrapped(run: str) -> bool:
    """Whether the run is the base64 of an armoured key, or of a token or base64 key that is all it holds."""
    raw = decoded(run)
    if raw is None or not raw.isascii():
        return False
    inner = raw.decode().strip()
    if inner.startswith("-----BEGIN "):
        return bool(armoured_keys(inner))
    return is_signed_token(inner) if inner.startswith("eyJ") else inner[:1] == "M" and not inner.translate(_INNER) and _key_in(inner)


def _kind_of(run: str) -> int | None:
    return 4 if _key_in(run) else 6 if _wrapped(run) else None


_USUAL = re.compile(rf"[A-Za-z0-9+/]{{{LEAST_ENCODED},}}={{0,2}}")
_INNER = {c: None for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="}


def confirmed_spans(text: str, raw: bytes, data: np.ndarray, place: np.ndarray | None) -> list[Span]:
    """Spans of armoured keys, encoded keys, tokens and wrapped ones, whose structure holds; none lies within another of them."""
    armoured = armoured_keys(text) if b"PRIVATE KEY" in raw else []
    found = [(a, 3, b) for a, b in armoured]
    if b"eyJ" in raw:
        for m in _TOKEN.finditer(text):
            parts = m[0].split(".")
            whole = next((t for t in (".".join(parts[:n]) for n in (5, 3)) if is_signed_token(t)), "")
            if whole:
                found.append((m.start(), 5, m.start() + len(whole)))
    taken = sorted((a, b) for a, _, b in found)
    starts, ends = _runs(_ENCODED[data], LEAST_ENCODED)
    for low, high in zip(starts.tolist(), ends.tolist(), strict=True):
        padding = 0
        while padding < 2 and raw[high + padding : high + padding + 1] == b"=":
            padding += 1
        a, b = (low, high + padding) if place is None else (int(place[low]), int(place[high + padding]))
        if any(x < b and a < y for x, y in taken):
            continue
        run = raw[low : high + padding].decode()
        kind = _kind_of(run)
        if kind is not None:
            found.append((a, kind, b))
        elif "-" in run or "_" in run:  # perhaps glued to a name; the usual alphabet has neither
            own = ((m, _kind_of(m[0])) for m in _USUAL.finditer(run))
            found += [(a + m.start(), kind, a + m.end()) for m, kind in own if kind is not None]
    return found


def _find(batches):
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"]
    for batch in pieces(batches, 1):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            raw = text.encode()
            data = np.frombuffer(raw, np.uint8)
            place = None if len(raw) == len(text) else np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
            if place is not None:  # the code point that a byte belongs to, which is the count before it at a first byte
                place = place.astype(np.int64)
            base = sorted(base_spans(text, raw, data, place))
            more = confirmed_spans(text, raw, data, place)
            written = [",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans) for spans in (base, sorted(base + more))]
            counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            rows.append((doc_id, *counts, hashlib.sha256(written[0].encode()).hexdigest(), written[1], len(more)))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)


def secret_scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts ``n_assign`` ``n_access`` ``n_hex``, ``base_sha256``, ``spans``, ``n_confirmed`` for every row of ``docs(doc_id, text)``.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind as in ``KINDS``. Base spans are the
    matches of the three fixed patterns; ``n_confirmed`` counts the others, which decoding has confirmed. A confirmed span
    may overlap base spans, never another confirmed one. Null and empty texts have none. Rows without an id and
    rows that repeat are judged each. Other columns are not read. An empty table gives an empty result.
    """
    kind = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long"
    return bounded(docs.select("doc_id", "text")).mapInArrow(_find, kind)
