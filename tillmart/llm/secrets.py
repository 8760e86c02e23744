"""Secrets in texts, confirmed by their structure.

Three base patterns are reported as they match. Further candidates (base64 and hex
runs, armoured blocks, dotted tokens) are reported only after decoding: a private key
must parse as DER whose nested lengths fill each other exactly, or as an OpenSSH key
whose length fields do; a signed token needs a JSON header that names an algorithm
and a JSON payload; an encoded text must hold a base secret itself.

Defined results: a null text is empty; overlapping spans of different kinds are all
reported; spans count code points, the end is exclusive. Added spans are cut to the
encoded value. Layers are decoded until one is too short for any secret; each is
shorter than the one around it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Columns, Taken, map_rows, only, table

# Base kinds and patterns, in the order in which ties are listed.
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# The same spans as runs of any length from which short ones are dropped.
_HEX = re.compile(r"[0-9a-f]{16,}")

ADDED = ("signed_token", "private_key", "encoded_secret")
_RANK = {kind: i for i, kind in enumerate(BASE + ADDED)}

_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*)?")
# Inside strings of source code or JSON, line breaks and slashes are escaped, maybe twice.
_ESCAPE = re.compile(r"\\+(?:u00([0-9a-fA-F]{2})|[nrt\s]|(/))")
_ARMOUR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----"
    r"((?:[A-Za-z0-9+/=\s]++|\\++(?:u00[0-9a-fA-F]{2}|[nrt/\s]))++)-----END \1-----"
)
# The shortest base secret has 18 characters: 24 of base64, 36 hex digits.
_RUN64 = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_RUN16 = re.compile(r"[0-9a-fA-F]{36,}")
# Every name that begins an assignment holds one of these.
_NAMES = ("passw", "secret", "token", "api")
_OPENSSH = b"openssh-key-v1\x00"


def _base(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds."""
    found, low = [], text.lower()
    if any(name in low for name in _NAMES):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def _unbase64(value: str) -> bytes | None:
    """Decoded bytes of either alphabet, with or without padding."""
    value = "".join(value.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(value + "=" * (-len(value) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der(data: bytes, start: int, end: int, depth: int = 0) -> list[int] | None:
    """Tags that fill ``data[start:end]`` exactly, children included; else None."""
    tags = []
    while start < end:
        if end - start < 2 or depth > 12:
            return None
        tag, size = data[start], data[start + 1]
        start += 2
        if size & 0x80:
            wide = size & 0x7F
            if not 1 <= wide <= 4 or start + wide > end:
                return None
            size = int.from_bytes(data[start : start + wide], "big")
            start += wide
        if start + size > end:
            return None
        if tag & 0x20 and _der(data, start, start + size, depth + 1) is None:
            return None
        tags.append(tag)
        start += size
    return tags


def is_private_key(data: bytes) -> bool:
    """DER private keys (PKCS#1, PKCS#8, SEC 1) and OpenSSH's own encoding."""
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        for _ in range(3):  # cipher, derivation, its options
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if not 1 <= keys <= 16:
            return False
        for _ in range(keys + 1):  # public keys, then the private block
            if at + 4 > len(data):
                return False
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at == len(data)
    if len(data) < 40 or data[0] != 0x30:
        return False
    outer = _der(data, 0, len(data))
    if outer != [0x30]:
        return False
    head = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    tags = _der(data, head, len(data))
    version = data[head : head + 3] in (b"\x02\x01\x00", b"\x02\x01\x01")
    if not tags or not version:
        return False
    rsa = len(tags) >= 9 and set(tags) <= {0x02, 0x30}
    return rsa or tags[:3] == [0x02, 0x30, 0x04] or tags[:2] == [0x02, 0x04]


def _unhex(value: str) -> bytes:
    """Decoded bytes; an odd last digit is not part of them."""
    return bytes.fromhex(value[: len(value) // 2 * 2])


def _json(part: str) -> dict | None:
    data = _unbase64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(value: str) -> bool:
    """A header that names its algorithm, and a payload."""
    head, body, *rest = value.split(".")
    header = _json(head)
    if not header or not isinstance(header.get("alg"), str) or _json(body) is None:
        return False
    return bool(rest and rest[0]) or header["alg"].lower() == "none"


def _unescape(value: str) -> str:
    """Escaped characters written out; escaped white space is left out."""
    return _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else m[2] or "", value)


def _is_text(text: str) -> bool:
    """No control characters but white space, and none without a meaning."""
    if text.isprintable():
        return True
    odd = {c for c in text if not c.isprintable()} - set("\r\n\t\f\v")
    return all(unicodedata.category(c) in ("Cf", "Zs", "Zl", "Zp") for c in odd)


def _decoded(data: bytes) -> str | None:
    """The added kind that decoded bytes prove, if any."""
    if is_private_key(data):
        return "private_key"
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    if not _is_text(text):
        return None
    if any(kind != "hex" for kind, _, _ in _base(text)) or _added(text):
        return "encoded_secret"
    return None


def _added(text: str) -> list[tuple[str, int, int]]:
    """Spans confirmed by their structure."""
    found = []
    if "eyJ" in text:
        found += [
            ("signed_token", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])
        ]
    if "-----BEGIN" in text:
        for m in _ARMOUR.finditer(text):
            data = _unbase64(_unescape(m[2]))
            if data and is_private_key(data):
                found.append(("private_key", *m.span()))
    taken = Taken(found)
    for pattern, decode in ((_RUN64, _unbase64), (_RUN16, _unhex)):
        for m in pattern.finditer(text):
            data = decode(m[0])
            kind = _decoded(data) if data else None
            if kind and taken.add(*m.span()):
                found.append((kind, *m.span()))
    return found


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets, by start, then kind as listed."""
    text = text or ""
    found = set(_base(text)) | set(_added(text))
    return sorted(found, key=lambda s: (s[1], _RANK[s[0]], s[2]))


def _rows(columns: Columns) -> Columns:
    spans = [
        [{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)]
        for t in columns["text"]
    ]
    return {"doc_id": columns["doc_id"], "spans": spans}


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and the spans of each row of ``docs`` (``doc_id``, ``text``)."""
    return map_rows(
        only(docs, "doc_id", "text"),
        "doc_id long, spans array<struct<kind: string, start: long, end: long>>",
        _rows,
    )


def joined(spans) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans and the text of all spans."""
    spans = F.col("spans")
    def of(*wanted: str):
        return F.filter(spans, lambda s: s["kind"].isin(*wanted))

    base = of(*kinds)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return digests(scan_secrets(table(spark, sf_dir, "documents")), BASE)
