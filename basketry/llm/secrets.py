"""Secret scan with structural confirmation.

Pattern matches (assignments, access keys, hex runs) are reported as they are.
Encoded candidates are reported only when their structure holds: base64 and
hex are decoded and must be a key container whose nested lengths add up, a
signed token must carry a JSON header that names an algorithm.

Kinds, in order:
  assign  password|passwd|secret|token|api key, then : or = and a value of 12+
  access  AKIA and 14+ capitals or digits
  hex     16+ lower-case hex digits
  token   signed token: three base64url parts, JSON header with "alg"
  key     base64 or hex of a DER key structure, an SSH wire key or an OpenSSH private key
  armor   BEGIN/END block whose body is base64 of a DER or OpenSSH key

Positions are code points, end exclusive. Null text counts as empty; the
functions work on one column, so repeated rows and extra columns do not matter.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.llm.common import joined_spans, strings, structs

KINDS = {k: i for i, k in enumerate(("assign", "access", "hex", "token", "key", "armor"))}
BASE = ("assign", "access", "hex")
Span = tuple[int, int, str]

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: A failing match is dropped whole; for these two the longest run decides, so the length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(ey[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
#: Base64 that can open a key: 30 8x (DER), 00 00 00 (SSH wire), "openssh-key-v1".
BASE64 = re.compile(r"(?<![A-Za-z0-9+/])(?:M[A-P]|AAAA|b3BlbnNzaC1rZXkt)[A-Za-z0-9+/]{30,}={0,2}")
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30[0-9A-Fa-f]|000000)[0-9A-Fa-f]{48,}")
ARMOR = re.compile(r"-----BEGIN ([A-Z0-9 ]{3,40})-----([^-]+)-----END \1-----")


def base_spans(text: str) -> Iterator[Span]:
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            yield m.start(), m.end(), "assign"
    for m in ACCESS.finditer(text):
        yield m.start(), m.end(), "access"
    for m in HEX.finditer(text):
        yield m.start(), m.end(), "hex"


def _base64(text: str) -> bytes | None:
    body = text.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _der(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None when its length does not fit."""
    if at + 2 > end:
        return None
    tag, first = data[at], data[at + 1]
    at += 2
    if first >= 0x80:
        n = first & 0x7F
        if not 1 <= n <= 4 or at + n > end or data[at] == 0:
            return None
        first, at = int.from_bytes(data[at:at + n], "big"), at + n
        if first < 0x80:
            return None  # not the shortest form
    return (tag, at, at + first) if at + first <= end else None


def _der_children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Values that fill [at, end) exactly, or None."""
    out = []
    while at < end:
        if (child := _der(data, at, end)) is None:
            return None
        out.append(child)
        at = child[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A SEQUENCE that fills the data and opens like a private or public key."""
    top = _der(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    children = _der_children(data, top[1], top[2])
    if not children or len(children) < 2:
        return False
    tags = [c[0] for c in children]
    inner = [c for c in children if c[0] == 0x30]
    if any(_der_children(data, s, e) is None for _, s, e in inner):
        return False
    if tags[0] == 0x02 and children[0][2] - children[0][1] == 1:  # version, then key numbers, an algorithm or an octet string
        return len(tags) >= 9 and set(tags[:9]) == {0x02} or tags[1:3] == [0x30, 0x04] or tags[1] == 0x04
    if tags[:2] == [0x30, 0x03]:  # algorithm and bit string
        return _der_children(data, inner[0][1], inner[0][2])[0][0] == 0x06
    return False


def is_wire_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first a key type name."""
    at, fields = 0, []
    while at + 4 <= len(data):
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return at == len(data) and len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0]) is not None


def is_openssh_key(data: bytes) -> bool:
    """Magic, cipher, key derivation, options, one or more keys, public key, private part."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        n = int.from_bytes(data[at:at + 4], "big")
        at += 4 + n
    keys = int.from_bytes(data[at:at + 4], "big")
    at += 4
    if not 1 <= keys <= 64:
        return False
    for _ in range(keys + 1):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at == len(data)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_der_key(data) or is_wire_key(data) or is_openssh_key(data))


def is_token(header: str, payload: str) -> bool:
    """The header is a JSON object that names its algorithm; the payload decodes."""
    raw = _base64(header)
    if raw is None or _base64(payload) is None:
        return False
    try:
        value = json.loads(raw)
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and isinstance(value.get("alg"), str)


def structural_spans(text: str) -> Iterator[Span]:
    if "ey" in text:
        for m in TOKEN.finditer(text):
            if is_token(m[1], m[2]):
                yield m.start(), m.end(), "token"
    for m in BASE64.finditer(text):
        if is_key(_base64(m[0])):
            yield m.start(), m.end(), "key"
    for m in HEX_KEY.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            yield m.start(), m.end(), "key"
    if "-----BEGIN " in text:
        for m in ARMOR.finditer(text):
            body = "".join(x for x in m[2].split() if ":" not in x)
            if is_key(_base64(body)):
                yield m.start(), m.end(), "armor"


def spans(text: str) -> list[Span]:
    """All spans of a text: pattern matches and confirmed structures."""
    return [*base_spans(text), *structural_spans(text)]


def masked(text: str, mark: str = "[secret]") -> str:
    """The text with every span, overlaps merged, replaced by the mark."""
    out, at = [], 0
    for s, e, _ in sorted(spans(text)):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


REPORT = pa.struct([
    ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
    ("spans", pa.string()), ("n_confirmed", pa.int64()),
])


def _report(text: str) -> tuple:
    found = spans(text)
    base = [x for x in found if x[2] in BASE]
    count = [sum(x[2] == k for x in base) for k in BASE]
    digest = hashlib.sha256(joined_spans(base, KINDS).encode()).hexdigest()
    return (*count, digest, joined_spans(found, KINDS), len(found) - len(base))


def report(text: Column) -> Column:
    """Struct of counts by base kind, digest of the base spans, all spans and the number confirmed by structure."""

    @F.arrow_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_confirmed long")
    def run(column: pa.Array) -> pa.Array:
        return structs(REPORT, map(_report, strings(column)))

    return run(text)


def mask(text: Column, mark: str = "[secret]") -> Column:
    """The text with secrets replaced; null stays null."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([None if t is None else masked(t, mark) for t in column.to_pylist()], pa.string())

    return run(text)
