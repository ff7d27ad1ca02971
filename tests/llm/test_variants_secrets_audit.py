"""Spelling variants, secret scan and filter audit against brute force."""

from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from llm_rows import ROWS, prose

from tidegauge.llm.filter_audit import filter_audit
from tidegauge.llm.key_encodings import is_private_key, is_signed_token
from tidegauge.llm.secrets import secret_scan
from tidegauge.llm.spelling import FILTER_BYTES, LONGEST, planned, spelling_variants

# Spelling variants


def variants(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += len(word) >= 6
    n = {w: c for w, c in counts.items() if c >= 5}
    near = defaultdict(set)
    for a in n:
        for b in n:
            if a < b and abs(len(a) - len(b)) <= 1:
                short, long = sorted((a, b), key=len)
                if len(a) == len(b):
                    close = sum(x != y for x, y in zip(a, b, strict=True)) == 1
                else:
                    close = any(long[:k] + long[k + 1 :] == short for k in range(len(long)))
                if close:
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def found_variants(docs, **options):
    return sorted(tuple(r) for r in spelling_variants(docs, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def misspelt():
    r = random.Random(4)
    letters = "abcdeé×ÿ"
    roots = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(30)] + ["aaaaaa", "aaaaaaa", "bbbbbbc", "É" * 7]

    def edited(word):
        k = r.randrange(len(word))
        return r.choice((word[:k] + word[k + 1 :], word[:k] + r.choice(letters) + word[k:], word[:k] + r.choice(letters) + word[k + 1 :]))

    once = [edited(w) for w in roots for _ in range(6)]
    twice = [edited(w) for w in once[::2]]
    words = roots * 400 + once * 40 + twice * 6 + ["q" * 90] * 30 + ["q" * 89] * 6 + [f"{w.upper()}" for w in roots]
    r.shuffle(words)
    return [(None if k % 50 == 0 else k, r.choice((" ", ", ", "1", "\n")).join(words[k * 20 : k * 20 + 20])) for k in range(len(words) // 20 + 1)]


@pytest.mark.parametrize("limit", [FILTER_BYTES, 64])
def test_variants_equal_brute_force_with_one_filter_or_several(frame, misspelt, limit):
    want = variants(misspelt)
    assert any(f and f != root for _, f, root, *_ in want) and any(len(w) > LONGEST for w, *_ in want)
    assert found_variants(frame(misspelt), limit=limit) == want


def test_a_filter_keeps_its_limit():
    for counts in ({}, {6: 1}, {6: 10**7, 7: 3, LONGEST: 10**6}, {k: 10**8 for k in range(6, 30)}):
        shards = planned(counts, 1 << 20)
        assert shards.blocks * 8 <= (1 << 20) + 8 * LONGEST
        assert shards.rounds == 1 or shards.rounds * (1 << 20) >= sum(counts.values()) * 2


def test_variants_of_edge_cases(frame, edges, nothing):
    assert found_variants(edges) == variants(ROWS)
    assert found_variants(nothing) == found_variants(frame([(1, "only rare words here")])) == []
    same = [(7, "hidden hiddon " * 3)] * 20
    assert found_variants(frame(same)) == variants(same)


# Secrets


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([128 + (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8)
    return bytes([tag]) + head + body


def number(value):
    return der(2, value.to_bytes(value.bit_length() // 8 + 1))


def rsa_key(bits=512, seed=1):
    r = random.Random(seed)
    p, q = (r.getrandbits(bits) | 1 << bits - 1 | 1 for _ in range(2))
    return der(48, *(number(x) for x in (0, p * q, 65537, r.getrandbits(2 * bits - 2), p, q, r.getrandbits(bits - 2), r.getrandbits(bits - 2), r.getrandbits(bits - 2))))


RSA_NAME, PBES2 = der(6, bytes.fromhex("2a864886f70d010101")), der(6, bytes.fromhex("2a864886f70d01050d"))
CURVE = der(6, bytes.fromhex("2a8648ce3d030107"))
BYTES = random.Random(9).randbytes
EC_KEY = der(48, number(1), der(4, BYTES(32)), der(0xA0, CURVE), der(0xA1, der(3, b"\0\4" + BYTES(64))))
KEYS = {
    "rsa": rsa_key(),
    "ec": EC_KEY,
    "dsa": der(48, number(0), *(number(1 << 8 * n - 2 | 5) for n in (128, 20, 128, 127, 20))),
    "pkcs8": der(48, number(0), der(48, RSA_NAME, der(5)), der(4, rsa_key(seed=2))),
    "pkcs8 ec": der(48, number(0), der(48, der(6, bytes.fromhex("2a8648ce3d0201")), CURVE), der(4, EC_KEY)),
    "ed25519": der(48, number(0), der(48, der(6, bytes.fromhex("2b6570"))), der(4, der(4, BYTES(32)))),
    "encrypted": der(48, der(48, PBES2, der(48, der(48))), der(4, BYTES(160))),
    "pkcs12": der(48, number(3), der(48, der(6, bytes.fromhex("2a864886f70d010701")), der(0xA0, der(4, der(48, number(7), der(4, BYTES(100))))))),
}


def string(body):
    return len(body).to_bytes(4) + body


def openssh(check=b"abcd" * 2):
    kind, point = string(b"ssh-ed25519"), string(BYTES(32))
    private = check + kind + point + string(BYTES(64)) + string(b"me@host")
    private += bytes(range(1, 1 + -len(private) % 8))
    return b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + (1).to_bytes(4) + string(kind + point) + string(private)


KEYS["openssh"] = openssh()


def plain(raw):
    return base64.b64encode(raw).decode()


def safe(raw):
    return base64.urlsafe_b64encode(raw).decode().rstrip("=")


def armour(raw, name="PRIVATE KEY", headers=""):
    body = plain(raw)
    lines = "\n".join(body[k : k + 64] for k in range(0, len(body), 64))
    return f"-----BEGIN {name}-----\n{headers}{lines}\n-----END {name}-----"


def token(alg="HS256", size=32, claims=b'{"sub":"1"}', **more):
    return ".".join((safe(json.dumps({"alg": alg, **more}).encode()), safe(claims), safe(BYTES(size))))


def test_keys_hold_only_whole():
    for name, raw in KEYS.items():
        assert is_private_key(raw), name
        assert not is_private_key(raw[:-1]) and not is_private_key(raw + b"\0"), name
        for k in range(1, 8):  # a length or tag that does not fit
            assert name in ("encrypted", "openssh") or not is_private_key(raw[:k] + bytes([raw[k] ^ 0x11]) + raw[k + 1 :]) or k > 1, name
    assert not is_private_key(openssh(b"abcdabce")) and not is_private_key(b"") and not is_private_key(b"0")
    assert not is_private_key(der(48, RSA_NAME)) and not is_private_key(der(48, der(48, RSA_NAME, der(5)), der(3, b"\0" + rsa_key())))  # a public key
    assert not is_private_key(b"0\x84\x00\x00\x01\x00" + b"\0" * 256) and not is_private_key(b"0\x80" * 10_000)


def test_tokens_hold_with_header_and_signature():
    good = [token(), token("RS256", 256), token("ES512", 132), token("none", 0), token("EdDSA", 64, typ="JWT")]
    assert all(map(is_signed_token, good))
    bad = [token(size=31), token("XX", 32), token(claims=b"[1]"), token(claims=b"not json"), good[0] + ".x", "a.b.c", "eyJ.eyJ.", token("none", 5)]
    assert not any(map(is_signed_token, bad))
    sealed = ".".join(safe(x) for x in (b'{"alg":"dir","enc":"A256GCM"}', b"", BYTES(12), BYTES(40), BYTES(16)))
    assert is_signed_token(sealed) and not is_signed_token(sealed[:-6])


def base_brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def spans_of(row):
    return [(kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in row["spans"].split(",") if s)]


def test_base_spans_equal_their_patterns(frame, edges, nothing):
    r = random.Random(5)
    bits = ["password", "PassWD", "secret", "toKen", "token", "api_key", "APIKEY", "apikey", '"', "'", " ", "   ", ":", "=", "==", "AKIA", "AKIAABCDEFGHIJKL", "AKIAABC", "abcdefgh", "0123456789abcdef", "deadbeef", "é", "日本", "\n", "x-y/z+", "short", "ſecret: abcdefghij"]
    rows = [(k, "".join(r.choice(bits) for _ in range(r.randint(0, 40)))) for k in range(800)] + ROWS
    got = secret_scan(frame(rows)).collect()
    want = Counter()
    for i, text in rows:
        spans = base_brute(text or "")
        written = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        counts = Counter(k for _, k, _ in spans)
        want[i, counts[0], counts[1], counts[2], hashlib.sha256(written.encode()).hexdigest(), written] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"], r["spans"]) for r in got) == want
    assert sum(r["n_assign"] > 1 for r in got) > 20 and sum(r["n_access"] > 0 for r in got) > 50
    assert secret_scan(edges).count() == len(ROWS) and secret_scan(nothing).count() == 0


def test_confirmed_secrets_are_added_and_others_are_not(frame):
    key, jwt = KEYS["pkcs8"], token()
    planted = {
        "armour": [armour(KEYS[k], name) for k, name in (("rsa", "RSA PRIVATE KEY"), ("ec", "EC PRIVATE KEY"), ("pkcs8", "PRIVATE KEY"), ("encrypted", "ENCRYPTED PRIVATE KEY"), ("openssh", "OPENSSH PRIVATE KEY"))]
        + [armour(BYTES(128), "RSA PRIVATE KEY", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\n"), armour(key).replace("\n", "\\n"), armour(key).replace("\n", "\r\n")],
        "key": [plain(raw) for raw in KEYS.values()] + [safe(key), key.hex(), key.hex().upper(), KEYS["openssh"].hex()],
        "token": [jwt, token("RS512", 512), token("none", 0)],
        "wrapped": [plain(armour(key).encode()), plain(jwt.encode()), plain(plain(key).encode() + b"\n")],
    }
    rows, want = [], {}
    for kind, texts in planted.items():
        for text in texts:
            for before, after in (("", ""), ("é日 key is ", " and so on."), ("x='", "'\n")):
                want[len(rows)] = (kind, len(before), len(before) + len(text))
                rows.append((len(rows), before + text + after))
    bad = [armour(key[:-1]), armour(BYTES(300)), "-----BEGIN PRIVATE KEY-----" * 3, plain(key[:-2]), plain(BYTES(400)), (key + b"1").hex(), token(size=30), plain(b"no key in here, only words that are long enough"), jwt[:-3], armour(der(48, der(48, RSA_NAME, der(5)), der(3, b"\0" + key)), "PUBLIC KEY")]
    clean = len(rows)
    rows += [(clean + k, f"before {text} after") for k, text in enumerate(bad)]
    rows += [(clean + 100, f"key_{plain(key)}"), (clean + 101, f"{jwt}. {armour(key)} {plain(key)}"), (clean + 102, "-" * 300_000 + "eyJ" * 100_000 + "=" * 50_000 + "M" * 500_000)]
    got = {r["doc_id"]: r for r in secret_scan(frame(rows)).collect()}
    for i, span in want.items():
        more = [s for s in spans_of(got[i]) if s[0] not in ("assign", "access", "hex")]
        assert more == [span], (i, rows[i][1][:80])
        assert got[i]["n_confirmed"] == 1
    assert all(got[clean + k]["n_confirmed"] == 0 for k in range(len(bad)))
    assert spans_of(got[clean + 100])[0] == ("key", 4, 4 + len(plain(key)))
    assert [s[0] for s in spans_of(got[clean + 101])] == ["token", "armour", "key"] and not got[clean + 102]["n_confirmed"]


# Filter audit


def audit(docs, labels):
    """``docs``: id, text, source; ``labels``: id, quality, toxic."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    out = {}
    for part in {s or "" for *_, s in docs}:
        masks = []
        for i, text, s in docs:
            if (s or "") == part:
                text = text or ""
                words = re.findall(r"[^\x20\x09-\x0D]+", text)
                fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and least[text] < i}
                masks.append(({f for f, no in fails.items() if no}, i in good and i is not None, i in toxic and i is not None))
        total = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [m for m in masks if letter in m[0] and not m[0] & before]
                total[letter] += len(removed)
                out[part, order, step] = [
                    sum(not m & (before | {letter}) for m, *_ in masks),
                    len(removed),
                    sum(letter in m and bool(m & before) for m, *_ in masks),
                    sum(m == {letter} for m, *_ in masks),
                    sum(g for _, g, _ in removed),
                    sum(t for *_, t in removed),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(total[key[1][key[2] - 1]])
    return {(*k, *v) for k, v in out.items()}


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(i, t, s, "x", "y") for i, t, s in docs], "doc_id long, text string, source string, mask string, part string").repartition(5)
    got = filter_audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).select(NAMES).collect()
    assert len(got) == len(set(map(tuple, got)))
    return set(map(tuple, got))


def test_audit_equals_brute_force(spark):
    r = random.Random(8)
    texts = [prose(k, n) + extra for k, n in enumerate((10, 49, 50, 51, 200)) for extra in ("", " #", " A" * 9, " the the" * 40, " the" * 60 + "$ AA")] + [None, "", " \t\x0b ", "É ü"]
    docs = [(None if k % 37 == 0 else k // 2 if k % 41 == 0 else k, texts[0] if k % 3 == 0 else r.choice(texts), r.choice(["a", "b", "", None])) for k in range(400)]
    labels = [(k, r.choice((0, 1, None)), r.choice((0, 1, None))) for k in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    docs += [docs[5], docs[5], (0, texts[0], "b"), (0, texts[0], "c")]
    assert audited(spark, docs, labels) == audit(docs, labels)


def test_audit_of_edge_cases(spark):
    docs = [(i, t, "s") for i, t in ROWS]
    assert audited(spark, docs, []) == audit(docs, [])
    assert audited(spark, [], [(1, 1, 1)]) == set()
    one = audited(spark, [(1, " ".join(map(str, np.arange(60))), None)], [(1, 1, 1)])
    assert len(one) == 600 and {row[3:] for row in one} == {(1, 0, 0, 0, 0, 0, 0)}
