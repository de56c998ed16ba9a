"""Secrets in text: patterns, and candidates confirmed by the structure of what they decode to.

``base_spans`` are three patterns. ``confirmed_spans`` decodes runs of base64 or hexadecimal digits and reports
those that hold a structure: a DER key whose nested lengths add up (``der``), length-prefixed strings of an SSH
key (``ssh``; of a private one all sections up to its end), a signed token whose first part is a JSON header naming its
algorithm (``jwt``), or text in which a base pattern is found (``nested``). A PEM body broken over lines is joined
before it is decoded; one that is encrypted can't be parsed, so its headers have to name a cipher and a start value
and its body has to be whole blocks (``pem``). Candidates that fail to decode or to parse are not reported.

Defined results: null and empty text has no spans; spans are code point offsets, end exclusive; null or repeated
ids are rows like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

# The base patterns.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt", "nested", "pem")

SIGNED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*)-----((?:\r?\n[A-Za-z-]+: [^\n]*)*)([A-Za-z0-9+/=\s]*)-----END \1-----")
ENCRYPTED = re.compile(r"\nProc-Type: *4,ENCRYPTED(?=\s).*?\nDEK-Info: *[A-Z0-9-]+,([0-9A-Fa-f]{16,32})\s", re.S)
SSH_MARK = b"openssh-key-v1\0"
RUN = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]+")
KEYWORD = re.compile(r"(?:password|passwd|secret|token|api_?key)", re.A | re.I)

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    spans = []
    if KEYWORD.search(text):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_CHARS]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    return spans + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag and bounds of the value of one DER item inside data[at:end]."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
    return (tag, at, at + size) if at + size <= end else None


def is_der(data: bytes) -> bool:
    """A sequence that fills the data, of items that fill it, with a number, key or object name among them."""
    outer = _item(data, 0, len(data))
    if not outer or outer[0] != 0x30 or outer[2] != len(data):
        return False
    stack, items, telling = [outer], 0, False
    while stack:
        _, at, end = stack.pop()
        while at < end:
            item = _item(data, at, end)
            if not item:
                return False
            items += 1
            size = item[2] - item[1]
            telling |= item[0] in (0x02, 0x03, 0x04, 0x06) and size >= (3 if item[0] == 0x06 else 8)
            if item[0] in (0x30, 0x31, 0xA0, 0xA1):
                stack.append(item)
            at = item[2]
    return items >= 2 and telling


def _strings(data: bytes, at: int, most: int | None = None) -> tuple[list[bytes], int] | None:
    """Length-prefixed strings from a place on, at most so many, and where they end."""
    parts = []
    while at < len(data) and (most is None or len(parts) < most):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        parts.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return parts, at


def is_ssh(data: bytes) -> bool:
    """Length-prefixed strings that fill the data, the first a key type; or all sections of a private key."""
    if data.startswith(SSH_MARK):
        head = _strings(data, len(SSH_MARK), 3)  # cipher, derivation and its options
        if not head or len(head[0]) < 3 or head[1] + 4 > len(data):
            return False
        keys = int.from_bytes(data[head[1] : head[1] + 4], "big")
        rest = _strings(data, head[1] + 4)  # the public keys and one section of private ones
        return rest is not None and keys >= 1 and len(rest[0]) == keys + 1 and all(map(is_ssh, rest[0][:keys])) and len(rest[0][keys]) % 8 == 0
    found = _strings(data, 0)
    return found is not None and len(found[0]) >= 2 and re.match(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+$", found[0][0]) is not None


def is_encrypted(headers: str, data: bytes) -> bool:
    """The headers of an encrypted key before a body of whole blocks of its cipher."""
    start = ENCRYPTED.search(headers + "\n")
    return start is not None and len(data) >= 16 and len(data) % (len(start[1]) // 2) == 0


def decoded(run: str) -> Iterator[bytes]:
    """What a run of digits may stand for: bytes in hexadecimal and in either base64 alphabet."""
    if HEX_RUN.fullmatch(run) and len(run) % 2 == 0:
        yield bytes.fromhex(run)
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 != 1:
        try:
            yield base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
        except (binascii.Error, ValueError):
            return


def structure(data: bytes) -> str | None:
    if is_der(data):
        return "der"
    if is_ssh(data):
        return "ssh"
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return "nested" if text.isprintable() and base_spans(text) else None


def is_signed(header: str) -> bool:
    for data in decoded(header):
        try:
            value = json.loads(data)
        except (ValueError, RecursionError):
            continue
        if isinstance(value, dict) and isinstance(value.get("alg"), str):
            return True
    return False


def confirmed_spans(text: str) -> list[Span]:
    spans = [(m.start(), m.end(), "jwt") for m in SIGNED.finditer(text) if is_signed(m[1])]
    taken = [(start, end) for start, end, _ in spans]
    for m in PEM.finditer(text) if "-----BEGIN" in text else ():
        bodies = list(decoded("".join(m[3].split())))
        kinds = [k for data in bodies if (k := structure(data))]
        kinds += ["pem" for data in bodies if m[2] and m[1].endswith("PRIVATE KEY") and is_encrypted(m[2], data)]
        if kinds:
            spans.append((m.start(), m.end(), kinds[0]))
        taken.append((m.start(), m.end()))
    taken.sort()
    starts, reach = [start for start, _ in taken], list(accumulate((end for _, end in taken), max))
    for m in RUN.finditer(text):
        before = bisect_left(starts, m.end())
        if before and reach[before - 1] > m.start():
            continue
        kinds = [k for data in decoded(m[0]) if (k := structure(data))]
        if kinds:
            spans.append((m.start(), m.end(), kinds[0]))
    return spans


def joined(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in order)


def scan(docs: DataFrame) -> DataFrame:
    """Per document the counts of the base patterns, the digest of their spans, and all spans."""
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                count = [sum(kind == k for _, _, kind in base) for k in KINDS[:3]]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*count, digest, joined(base + confirmed_spans(text or ""))))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
