"""What decoded bytes must look like to be a private key or a signed token: nested lengths that fit exactly.

Every parser takes whole bytes and says whether they are one encoding from the first byte to the last.
Depth is bounded by the encodings themselves, so a parser reads each byte a fixed number of times.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from typing import NamedTuple

# Tags of the distinguished encoding rules, prefixes of object identifiers (PKCS 5, PKCS 7 data, PKCS 12).
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
_PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_PKCS7_DATA = bytes.fromhex("2a864886f70d010701")
_OPENSSH = b"openssh-key-v1\0"
#: Bytes of a signature by the algorithm that a token's header names; None: at least 128, as long as the RSA modulus.
_SIGNATURES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "Ed25519": 64, "Ed448": 114, "none": 0} | dict.fromkeys(("RS256", "RS384", "RS512", "PS256", "PS384", "PS512"))


class Item(NamedTuple):
    tag: int
    body: bytes


def _item(data: bytes, at: int) -> tuple[Item, int] | None:
    """The item at a place and where it ends, if its length is written in the shortest form and fits."""
    if at + 2 > len(data):
        return None
    tag, first = data[at], data[at + 1]
    at += 2
    if first < 128:
        size = first
    else:
        n = first - 128
        if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
            return None
        size = int.from_bytes(data[at : at + n])
        if size < 128:
            return None
        at += n
    return (Item(tag, data[at : at + size]), at + size) if at + size <= len(data) else None


def items(data: bytes, most: int = 16) -> list[Item] | None:
    """Items that fill the data from end to end, or None; no key encoding has more than ``most`` side by side."""
    found, at = [], 0
    while at < len(data):
        one = _item(data, at)
        if one is None or len(found) == most:
            return None
        found.append(one[0])
        at = one[1]
    return found


def _inside(data: bytes, tag: int = SEQUENCE) -> list[Item] | None:
    """The items within the one item that the data is."""
    outer = items(data, 1)
    return items(outer[0].body) if outer and outer[0].tag == tag else None


def _tags(parts: list[Item]) -> list[int]:
    return [p.tag for p in parts]


def _number(part: Item) -> bytes:
    """A positive integer's bytes without the sign byte."""
    return part.body[1:] if part.body[:1] == b"\0" and len(part.body) > 1 else part.body


def _rsa(parts: list[Item]) -> bool:
    if len(parts) not in (9, 10) or _tags(parts[:9]) != [INTEGER] * 9 or parts[0].body not in (b"\0", b"\1"):
        return False
    modulus, p, q = (len(_number(parts[i])) for i in (1, 4, 5))
    return modulus >= 32 and p + q - 1 <= modulus <= p + q and all(len(_number(parts[i])) <= modulus for i in (2, 3, 6, 7, 8))


def _dsa(parts: list[Item]) -> bool:
    if _tags(parts) != [INTEGER] * 6 or parts[0].body != b"\0":
        return False
    p, q, g, y, x = (len(_number(part)) for part in parts[1:])
    return p >= 64 and q <= p and g <= p and y <= p and 16 <= x <= q


def _ec(parts: list[Item]) -> bool:
    if len(parts) < 2 or _tags(parts[:2]) != [INTEGER, OCTETS] or parts[0].body != b"\1" or not 16 <= len(parts[1].body) <= 72:
        return False
    inner = {0xA0: OBJECT, 0xA1: BITS}
    return _tags(parts[2:]) in ([], [0xA0], [0xA1], [0xA0, 0xA1]) and all((x := items(p.body, 2)) is not None and _tags(x) == [inner[p.tag]] for p in parts[2:])


def _algorithm(part: Item) -> bytes | None:
    """The object identifier at the head of an algorithm, or None."""
    inner = items(part.body) if part.tag == SEQUENCE else None
    return inner[0].body if inner and inner[0].tag == OBJECT and len(inner) <= 2 else None


def _pkcs8(parts: list[Item]) -> bool:
    if _tags(parts[:3]) != [INTEGER, SEQUENCE, OCTETS] or parts[0].body not in (b"\0", b"\1"):
        return False
    if _algorithm(parts[1]) is None or not all(p.tag in (0xA0, 0x81, 0xA1) for p in parts[3:]):
        return False
    # The octets hold a key encoding of their own, or a curve's key as octets, or a number.
    inner = _inside(parts[2].body)
    if inner is not None and (_rsa(inner) or _ec(inner) or _dsa(inner)):
        return True
    one = items(parts[2].body, 1)
    return bool(one) and one[0].tag in (OCTETS, INTEGER) and len(one[0].body) >= 16


def _encrypted_pkcs8(parts: list[Item]) -> bool:
    if _tags(parts) != [SEQUENCE, OCTETS] or len(parts[1].body) < 16:
        return False
    return (_algorithm(parts[0]) or b"").startswith(_PASSWORD_SCHEMES)


def _pkcs12(parts: list[Item]) -> bool:
    if _tags(parts) not in ([INTEGER, SEQUENCE], [INTEGER, SEQUENCE, SEQUENCE]) or parts[0].body != b"\3":
        return False
    content = items(parts[1].body)
    return bool(content) and _tags(content) == [OBJECT, 0xA0] and content[0].body == _PKCS7_DATA and _inside(content[1].body, OCTETS) is not None


def _strings(data: bytes, count: int) -> tuple[list[bytes], bytes] | None:
    """So many strings, each after its length in four bytes, and the rest."""
    found = []
    for _ in range(count):
        size = int.from_bytes(data[:4])
        if len(data) < 4 or len(data) < 4 + size:
            return None
        found.append(data[4 : 4 + size])
        data = data[4 + size :]
    return found, data


def _openssh(data: bytes) -> bool:
    if not data.startswith(_OPENSSH):
        return False
    head = _strings(data[len(_OPENSSH) :], 3)
    if head is None or len(head[1]) < 4:
        return False
    (cipher, _, _), rest = head
    body = _strings(rest[4:], 2) if rest[:4] == b"\0\0\0\1" else None
    if body is None or body[1]:
        return False
    public, private = body[0]
    named = _strings(public, 1)
    # An open key starts with one check number twice and then says the kind that the public part says.
    return named is not None and len(private) % 8 == 0 and len(private) >= 16 and (cipher != b"none" or (private[:4] == private[4:8] and _strings(private[8:], 1) is not None and _strings(private[8:], 1)[0] == named[0]))


def is_private_key(data: bytes) -> bool:
    """RSA, DSA, curve, PKCS 8 (open or encrypted), PKCS 12 or OpenSSH private key, whole."""
    if data[:1] == b"o":
        return _openssh(data)
    parts = _inside(data)
    return bool(parts) and (_rsa(parts) or _dsa(parts) or _ec(parts) or _pkcs8(parts) or _encrypted_pkcs8(parts) or _pkcs12(parts))


def is_secret_packet(data: bytes) -> bool:
    """OpenPGP packets that fill the data, the first a secret key."""
    at = count = 0
    while at < len(data):
        head = data[at]
        if not head & 0x80:
            return False
        if head & 0x40:
            tag, first = head & 0x3F, data[at + 1] if at + 1 < len(data) else 255
            wide = 1 if first < 192 else 2 if first < 224 else 5
            if (wide == 5 and first != 255) or at + 1 + wide > len(data):
                return False
            raw = data[at + 1 : at + 1 + wide]
            size = raw[0] if wide == 1 else ((raw[0] - 192) << 8) + raw[1] + 192 if wide == 2 else int.from_bytes(raw[1:])
        else:
            tag, wide = head >> 2 & 15, (1, 2, 4, 0)[head & 3]
            if not wide or at + 1 + wide > len(data):
                return False
            size = int.from_bytes(data[at + 1 : at + 1 + wide])
        at += 1 + wide
        if at + size > len(data) or (not count and (tag != 5 or size < 6 or data[at] not in (3, 4, 5, 6))):
            return False
        at += size
        count += 1
    return count > 0


_URL_SAFE = str.maketrans("-_", "+/")


def decoded(text: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without padding, or None."""
    body = text.rstrip("=").translate(_URL_SAFE)
    if len(body) % 4 == 1 or len(text) - len(text.rstrip("=")) > 2:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _object(text: str) -> dict | None:
    raw = decoded(text)
    if raw is None or raw[:1] != b"{":
        return None
    try:
        found = json.loads(raw)
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(text: str) -> bool:
    """Three dotted parts with a header that names its algorithm, a claims object and a signature of the algorithm's length, or five of an encrypted token."""
    parts = text.split(".")
    header = _object(parts[0]) if len(parts) in (3, 5) else None
    if header is None or not isinstance(header.get("alg"), str):
        return False
    if len(parts) == 5:
        rest = [decoded(p) for p in parts[1:]]
        return isinstance(header.get("enc"), str) and None not in rest and len(rest[1]) >= 12 and len(rest[3]) >= 16
    if header["alg"] not in _SIGNATURES or _object(parts[1]) is None:
        return False
    signature, size = decoded(parts[2]) if parts[2] else b"", _SIGNATURES[header["alg"]]
    return signature is not None and (len(signature) == size if size is not None else len(signature) >= 128)


_ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----")
_SPACES = re.compile(r"[ \t\r\n]+")


def armoured_keys(text: str) -> list[tuple[int, int]]:
    """Bounds of armoured blocks, from ``-----BEGIN`` to the end of the matching last line, whose content is a private key."""
    found, free = [], 0
    for begin in _ARMOUR.finditer(text):
        if begin.start() < free:
            continue
        last = f"-----END {begin[1]}-----"
        nearest, end = text.find("-----", begin.end()), -1
        if nearest >= 0 and text.startswith(last, nearest):
            end = nearest + len(last)
        if end < 0:
            continue
        body = text[begin.end() : nearest].replace("\\r", "").replace("\\n", "\n")
        headers = body.strip().replace("\r", "").split("\n\n", 1) if ":" in body else [body]
        if armour_holds_key(begin[1], headers[-1], "ENCRYPTED" in headers[0] and len(headers) == 2):
            found.append((begin.start(), end))
            free = end
    return found


def armour_holds_key(name: str, body: str, sealed: bool) -> bool:
    """``sealed``: the headers say that the content is encrypted as a whole; then its length must be of whole blocks."""
    packet = name.startswith("PGP")
    if packet:  # the last line is a checksum
        body = body.strip().rpartition("\n=")[0] or body
    raw = decoded(_SPACES.sub("", body))
    if raw is None:
        return False
    return is_secret_packet(raw) if packet else len(raw) >= 64 and len(raw) % 8 == 0 if sealed else is_private_key(raw)
