"""Candidate spans of personal data in one text, and what labelers say about each."""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

#: The four kinds found by fixed patterns, and the kinds that only the trained classifier admits.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "number", "name")
KINDS = (*BASE_KINDS, *MORE_KINDS)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Every character of an ip, card or phone lies in such a stretch, which no two of them share.
_ZONE = re.compile(r"[+0-9][+0-9 ().-]*")
_DOTTED = re.compile(r"[0-9.]+")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SECRET = re.compile(r"""(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)["']?[ \t]{0,8}[:=][ \t]{0,8}["']?([^\s"']{6,})""")
_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{0,40}[0-9])[A-Za-z0-9+/_-]{16,}(?![A-Za-z0-9+/_-])")
_NAME = re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Mlle|Sra|Sr)\.? ([A-Z][a-z]{1,20}(?: [A-Z][a-z]{1,20})?)(?!\w)")

# Words before a span that speak for it or against it, known hosts and first names.
CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "from", "address", "client", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment", "account"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "key", "login", "aws"),
    "number": ("phone", "tel", "call", "ssn", "social", "account", "iban", "passport", "id"),
    "name": ("mr", "mrs", "ms", "dr", "herr", "frau", "mme", "name", "dear"),
}
AGAINST = frozenset(("version", "v", "isbn", "issn", "order", "page", "section", "build", "figure", "table", "chapter", "commit", "revision"))
HOSTS = frozenset(("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "gmx.de", "web.de", "orange.fr", "mail.ru", "proton.me"))
ENDINGS = frozenset(("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "ru", "io", "info", "eu", "us", "ca"))
KEY_HEADS = ("AKIA", "ASIA", "ghp_", "gho_", "sk_", "pk_", "xoxb-", "xoxp-", "AIza", "eyJ")
FIRST_NAMES = frozenset(
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah anna maria peter paul hans klaus karin jean pierre marie sophie jose juan carmen luis ana".split()
)
#: Votes of one span: pattern, check, gazetteer, words before, shape around, randomness.
LABELERS = 6


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = int(d) * (1 + place % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern from left to right, each found from its ``@``.

    The part before it has no ``@``, so a match starts where the run of its characters does, but
    not within the match before. Looking from each ``@`` keeps long runs from being scanned again.
    """
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            found.append((start, m.end()))
            free = m.end()
        at = text.find("@", at + 1)
    return found


def _ips(text: str, low: int, high: int) -> list[tuple[int, int, bool]]:
    """Four groups of digits joined by single dots, and whether no part is above 255."""
    found = []
    for chain in _DOTTED.finditer(text, low, high):
        groups = [m.span() for m in _DIGITS.finditer(text, *chain.span())]
        i = 0
        while i + 3 < len(groups):
            four = groups[i : i + 4]
            if all(b[0] - a[1] == 1 for a, b in zip(four, four[1:], strict=False)):
                parts = [text[a:b].lstrip("0") for a, b in four]
                found.append((four[0][0], four[3][1], all(len(p) < 4 and int(p or 0) < 256 for p in parts)))
                i += 4
            else:
                i += 1
    return found


def base_and_failed(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns that pass their check, and those that fail it."""
    good, bad = [Span(0, a, b) for a, b in emails(text)], []
    for zone in _ZONE.finditer(text):
        low, high = zone.span()
        if high - low < 3:
            continue
        for a, b, ok in _ips(text, low, high):
            (good if ok else bad).append(Span(1, a, b))
        for kind, pattern, least, most in ((2, _CARD, 14, 19), (3, _PHONE, 10, 15)):
            for m in pattern.finditer(text, low, high):
                digits = re.sub(r"[^0-9]", "", m[0])
                ok = least <= len(digits) <= most and (kind == 3 or luhn(digits))
                (good if ok else bad).append(Span(kind, *m.span()))
    return good, bad


def more_candidates(text: str, taken: list[Span], failed: list[Span]) -> list[Span]:
    """Spans of other kinds that overlap none taken: secrets, numbers that failed a check, names after a title."""
    found = [Span(4, *m.span(1)) for m in _SECRET.finditer(text)]
    found += [Span(4, *m.span()) for m in _KEY.finditer(text)]
    found += [Span(5, s.start, s.end) for s in failed if s.end - s.start >= 9]
    found += [Span(6, *m.span(1)) for m in _NAME.finditer(text)]
    out: list[Span] = []
    ends = sorted((s.start, s.end) for s in taken)
    free, i = 0, 0
    for s in sorted(found, key=lambda s: (s.start, -s.end)):
        while i < len(ends) and ends[i][1] <= s.start:
            i += 1
        if s.start >= free and (i == len(ends) or ends[i][0] >= s.end):
            out.append(s)
            free = s.end
    return out


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def described(text: str, span: Span, passed: bool) -> tuple[list[int], list[float]]:
    """Votes of the labelers (1 for, 0 against, 2 none) and the numbers the classifier sees."""
    kind, own = KINDS[span.kind], text[span.start : span.end]
    before = re.findall(r"[\w-]+", text[max(0, span.start - 40) : span.start].lower())[-4:]
    left, right = text[span.start - 1 : span.start], text[span.end : span.end + 1]
    glued = left.isalnum() or right.isalnum()
    digits, uppers, letters = (sum(map(f, own)) for f in (str.isdigit, str.isupper, str.isalpha))
    n, bits, distinct = max(len(own), 1), entropy(own), len(set(own))
    for_it, against = any(w in CUES[kind] for w in before), any(w in AGAINST for w in before)
    known = False
    if kind == "email":
        host = own.rpartition("@")[2].lower()
        known = host in HOSTS or host.rpartition(".")[2] in ENDINGS
    elif kind == "secret":
        known = own.startswith(KEY_HEADS)
    elif kind == "name":
        known = own.split(" ")[0].lower() in FIRST_NAMES
    elif kind == "ip":
        known = own.startswith(("10.", "192.168.", "172.16."))
    votes = [
        1 if span.kind < 4 or kind == "secret" else 2,
        (1 if passed else 0) if span.kind < 4 or kind == "number" else 2,
        1 if known else 2,
        1 if for_it and not against else 0 if against else 2,
        0 if glued else 2,
        2 if kind == "name" else (1 if bits > 2.5 and distinct > 5 else 0 if distinct < 4 else 2),
    ]
    numbers = [float(span.kind == k) for k in range(len(KINDS))]
    numbers += [math.log(n), digits / n, uppers / n, letters / n, bits, distinct / n, float(glued), float(for_it), float(against), float(known), float(passed)]
    return votes, numbers


#: Numbers per span.
WIDTH = len(KINDS) + 11
