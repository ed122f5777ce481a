"""Secret scan with structural confirmation.

Three plain patterns find assignments, access keys and hex runs (the *base*
spans, always kept). The method adds spans of encoded values that prove to be
keys: candidates in base64 or hex are decoded and parsed, and reported only if
the structure holds. A candidate in base64 is a run without an inner ``=`` (so an
assignment's name is left out), what follows a separator inside one, or
neighbouring lines of 64 or 76 characters and their rest.

- ``der``: PKCS#1, PKCS#8, EC or public-key DER; every nested length must fit
  and the first elements must be those of a key.
- ``pem``: an armoured block whose body decodes to such DER or to an OpenSSH key.
- ``ssh``: an OpenSSH key blob: length-prefixed fields that begin with a known key type.
- ``jwt``: a token whose first part decodes to a JSON object that names its
  algorithm, whose second part decodes to JSON, with a signature unless the
  algorithm is ``none``.

Positions are code points of the whole text, the end exclusive. Runs in Python
over Arrow batches in one scan without a shuffle; cheap substring tests leave
out patterns that cannot match.

Defined results: null text counts as empty; an empty text has no spans, an
empty ``spans`` and the SHA-256 of the empty string; rows that repeat give
repeated results; other columns aren't read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow, pieces

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
_RANK = {kind: i for i, kind in enumerate(KINDS)}
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 or more
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*KEY)-----(.*?)-----END \1-----", re.S)
_LONG = re.compile(r"[A-Za-z0-9+/_-]{40,}+={0,2}")
# a line of 64 or 76 characters and the lines that follow it
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{64}|[A-Za-z0-9+/_-]{76})(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]++)+={0,2}")
_INNER = re.compile(r"[/_+-]")
_DER_START, _SSH_START = re.compile(r"M[A-P]"), re.compile(r"AAAA[BCE]|b3Bl")
_HEX_BLOB = re.compile(r"[0-9A-Fa-f]{64,}+")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)")
# Key type names of the OpenSSH format.
_SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans of the three plain patterns."""
    low = text.lower()
    out = []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return out


def _unbase64(text: str) -> bytes | None:
    body = text.translate({45: 43, 95: 47}).rstrip("=")
    if len(body) % 4 == 1 or "=" in body:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of the DER element at ``at``; None if its length doesn't fit."""
    if end - at < 2:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        n = int.from_bytes(data[at : at + size], "big")
        at += size
        if n < 128:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        e = _element(data, at, end)
        if not e:
            return None
        out.append(e)
        at = e[2]
    return out


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one DER sequence, exactly filled, laid out as a private or public key."""
    top = _element(data, 0, len(data))
    if not top or top[0] != 0x30 or top[2] != len(data):
        return False
    parts = _elements(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    number = lambda p: data[p[1] : p[2]]
    if tags[0] == 0x30 and tags[1] == 0x03 and len(parts) == 2:  # public key: algorithm, bit string
        inner = _elements(data, parts[0][1], parts[0][2])
        return bool(inner) and inner[0][0] == 0x06 and data[parts[1][1] : parts[1][1] + 1] == b"\x00"
    if tags[0] != 0x02:
        return False
    if tags[1] == 0x30 and len(parts) > 2 and tags[2] == 0x04 and number(parts[0]) in (b"\x00", b"\x01"):  # PKCS#8
        inner = _elements(data, parts[1][1], parts[1][2])
        return bool(inner) and inner[0][0] == 0x06
    if tags[1] == 0x04 and number(parts[0]) == b"\x01" and parts[1][2] - parts[1][1] >= 16:  # EC private key
        return all(t in (0xA0, 0xA1) for t in tags[2:])
    if all(t == 0x02 for t in tags):  # PKCS#1: version and eight numbers, or modulus and exponent
        sizes = [p[2] - p[1] for p in parts]
        return len(parts) in (6, 9) and number(parts[0]) == b"\x00" and sizes[1] >= 32 or len(parts) == 2 and sizes[0] >= 32 and sizes[1] <= 8
    return False


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key or a public key of a known type with fitting field lengths."""
    if data.startswith(b"openssh-key-v1\x00"):
        data = data[15:]
        least, known = 3, None
    else:
        least, known = 2, _SSH_TYPES
    at, fields = 0, []
    while at + 4 <= len(data) and len(fields) < least:
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return len(fields) == least and (known is None and fields[0].isascii() and len(fields[0]) > 2 or known is not None and fields[0] in known)


def _key_kind(data: bytes | None) -> str | None:
    if not data or len(data) < 24:
        return None
    return "der" if data[0] == 0x30 and is_der_key(data) else "ssh" if data[:4] in (b"open", b"\x00\x00\x00\x07", b"\x00\x00\x00\x0b", b"\x00\x00\x00\x13") and is_ssh_key(data) else None


def is_token(head: str, body: str, signature: str) -> bool:
    """Whether the three parts are a signed token: JSON header with an algorithm, JSON payload, decodable signature."""
    try:
        first = json.loads(_unbase64(head) or b"")
        json.loads(_unbase64(body) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(first, dict) or not isinstance(first.get("alg"), str):
        return False
    return first["alg"].lower() == "none" if not signature else _unbase64(signature) is not None


def _within(spans: list[tuple[int, int]], at: int) -> bool:
    return any(a <= at < z for a, z in spans)


def _der_chars(text: str) -> int | None:
    """How many base64 characters, without padding, the DER sequence fills that begins with ``text``; None if it is none."""
    head = _unbase64(text[:8])
    if not head or len(head) < 6 or head[0] != 0x30:
        return None
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    if size > 4 or head[1] == 0x80:
        return None
    total = 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])
    return -(-total * 4 // 3)


def _keys_of_run(run: str, at: int) -> list[tuple[int, int, str]]:
    """The keys in a base64 run that begins at ``at``: the whole run, or what follows an inner separator.

    A separator of a path or name may also be a sign of base64, so every
    place after one that begins like a key is tried."""
    if kind := _key_kind(_unbase64(run)):
        return [(at, at + len(run), kind)]
    for m in _INNER.finditer(run):
        start = m.end()
        if len(run) - start < 32:
            break
        fits = _der_chars(run[start : start + 8]) == len(run.rstrip("=")) - start if _DER_START.match(run, start) else _SSH_START.match(run, start)
        if fits and (kind := _key_kind(_unbase64(run[start:]))):
            return [(at + start, at + len(run), kind)]
    return []


def _wrapped_key(m: re.Match) -> tuple[int, int, str] | None:
    """A key in neighbouring lines of base64: as many of the lines as one key fills, from the first that begins like one."""
    lines = list(re.finditer(r"[A-Za-z0-9+/_=-]+", m[0]))
    for i, first in enumerate(lines):
        if len(first[0]) not in (64, 76) or not (_DER_START.match(first[0]) or _SSH_START.match(first[0])):
            continue
        last = i
        while last + 1 < len(lines) and len(lines[last][0]) == len(first[0]) and len(lines[last + 1][0]) <= len(first[0]):
            last += 1
        size = _der_chars(first[0])
        # a line of text may follow the last one; DER says where it ends
        ends = (last, last - 1) if size is None else (i + -(-size // len(first[0])) - 1,)
        for end in ends:
            if i < end <= last and (kind := _key_kind(_unbase64("".join(x[0] for x in lines[i : end + 1])))):
                return m.start() + first.start(), m.start() + lines[end].end(), kind
    return None


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """The spans that decoding and parsing confirm."""
    out, armoured = [], []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            body = re.sub(r"^(?:[\w-]+: .*\n)+", "", m[2].strip())
            data = _unbase64(re.sub(r"\s+|\\n|\\r", "", body))
            if _key_kind(data) or "ENCRYPTED" in m[2] and data:
                out.append((m.start(), m.end(), "pem"))
                armoured.append((m.start(), m.end()))
    for m in _WRAPPED.finditer(text):
        if not _within(armoured, m.start()) and (found := _wrapped_key(m)):
            out.append(found)
            armoured.append(found[:2])
    for m in _LONG.finditer(text):
        if _within(armoured, m.start()):
            continue
        out += _keys_of_run(m[0], m.start())
        for h in _HEX_BLOB.finditer(m[0]):
            if len(h[0]) % 2 == 0 and (kind := _key_kind(bytes.fromhex(h[0]))):
                out.append((m.start() + h.start(), m.start() + h.end(), kind))
    if "." in text:
        out += [(m.start(), m.end(), "jwt") for m in _JWT.finditer(text) if is_token(m[1], m[2], m[3])]
    return list(dict.fromkeys(out))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for a, z, kind in sorted(spans, key=lambda s: (s[0], _RANK[s[2]], s[1])))


def scan_text(text: str | None) -> tuple[int, int, int, str, str]:
    """Counts of the base kinds, SHA-256 of the base spans, and all spans of one text."""
    text = text or ""
    base = base_spans(text)
    n = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
    return (*n, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + confirmed_spans(text)))


SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan(df: DataFrame) -> DataFrame:
    """One row for each row of ``df(doc_id, text)``: counts, digest of the base spans, and all spans as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            rows = list(zip(*(scan_text(t) for t in texts), strict=True))
            yield arrow(SCHEMA, dict(zip((c.split()[0] for c in SCHEMA.split(", ")), [part.column(0), *map(list, rows)], strict=True)))

    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
