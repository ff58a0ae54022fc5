"""Secrets in texts: patterns, and structures confirmed by decoding.

Base kinds are found by pattern alone.  The other kinds are candidates in base64 or hex whose decoded
bytes must parse: private keys in DER (PKCS#1, PKCS#8, SEC1, DSA and encrypted PKCS#8, by nested lengths and
structure), OpenSSH key files, PEM blocks around either, and signed tokens whose header names an algorithm.
Certificates and public keys are no secrets.  A DER key may be glued to other text, or wrapped over lines.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.tables import slices

# fixed values: the base patterns, with the smallest length of what counts
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
#: one of these is in every assignment's name
ASSIGN_PARTS = ("passw", "secret", "token", "api")
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "token", "der", "ssh")

PEM = re.compile(
    r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:\r?\n[A-Za-z-]+: [^\r\n]*)*)([A-Za-z0-9+/=\s\\nr]+?)-----END \1-----"
)
#: the first eight characters of a DER sequence of 128 bytes to 64 KiB in base64, and its text with line ends and quote marks
KEY_START = re.compile(r"MI[GHI-L][A-Za-z0-9+/]{5}")
WRAPPED = re.compile(r"(?:[A-Za-z0-9+/]|\r?\n(?:> ?|[ \t]+)?(?=[A-Za-z0-9+/]))*")
#: object identifiers of encryption by password begin so (PKCS#5, PKCS#12)
BY_PASSWORD = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
SSH_MAGIC = b"openssh-key-v1\x00"
SMALLEST_KEY = 24

Span = tuple[str, int, int]


def _bytes_of(text: str) -> Iterator[bytes]:
    """The byte strings that ``text`` may encode: hex, and base64 of either alphabet."""
    body = text.rstrip("=")
    if len(body) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", body):
        yield bytes.fromhex(body)
    if len(body) % 4 != 1:
        try:
            yield base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
        except (binascii.Error, ValueError):
            pass


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """A DER length at ``at``: (its value, where the content begins)."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return None
    value = int.from_bytes(data[at + 1 : at + 1 + n], "big")
    if value < 0x80 or value >> (8 * (n - 1)) == 0:  # DER takes the shortest form
        return None
    return value, at + 1 + n


def _values(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, first, end) of the DER values that fill ``data[at:end]``; None if they leave a gap."""
    found = []
    while at < end:
        held = _length(data, at + 1)
        if held is None or held[1] + held[0] > end or data[at] & 0x1F == 0x1F:
            return None
        found.append((data[at], held[1], held[1] + held[0]))
        at = found[-1][2]
    return found


def _nested(data: bytes) -> bool:
    """All lengths, at every level, nest without a gap."""
    level = [(0, len(data))]
    while level:
        values = _values(data, *level.pop())
        if values is None:
            return False
        level += [(first, end) for tag, first, end in values if tag & 0x20]
    return True


def is_der_key(data: bytes) -> bool:
    """One sequence whose lengths nest without a gap, with the parts of a private key."""
    if len(data) < SMALLEST_KEY or data[0] != 0x30 or not _nested(data):
        return False
    outer = _values(data, 0, len(data))
    if len(outer) != 1:
        return False
    parts = _values(data, *outer[0][1:])
    tags = [tag for tag, _, _ in parts]
    contents = [data[first:end] for _, first, end in parts]

    def algorithm(i: int) -> bytes:
        """The object identifier that an algorithm's sequence begins with."""
        inner = _values(data, *parts[i][1:])
        return data[inner[0][1] : inner[0][2]] if inner and inner[0][0] == 0x06 else b""

    if tags == [0x30, 0x04]:  # encrypted PKCS#8
        return algorithm(0).startswith(BY_PASSWORD) and bool(contents[1])
    if tags[:1] != [0x02] or contents[0] not in (b"\0", b"\1"):
        return False
    if tags[1:3] == [0x30, 0x04]:  # PKCS#8: version, algorithm, key
        return bool(algorithm(1)) and bool(contents[2])
    if tags[1:2] == [0x04]:  # SEC1: version, key, curve, public key
        return contents[0] == b"\1" and len(contents[1]) >= 16 and set(tags[2:]) <= {0xA0, 0xA1}
    # PKCS#1 has nine numbers (and further primes), DSA six
    return tags == [0x02] * 6 or (tags[:9] == [0x02] * 9 and tags[9:] in ([], [0x30]))


def _embedded_keys(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of DER keys in base64 that begin anywhere; their own length says where they end."""
    for m in KEY_START.finditer(text):
        size, at = _length(base64.b64decode(m[0]), 1) or (0, 0)
        letters = ((size + at) * 4 + 2) // 3
        run = WRAPPED.match(text, m.start(), m.start() + 2 * letters)[0]
        places = [i for i, c in enumerate(run) if c not in "\r\n> \t"][:letters]
        if size and len(places) == letters:
            body = "".join(run[i] for i in places)
            if is_der_key(base64.b64decode(body + "=" * (-letters % 4))):
                end = m.start() + places[-1] + 1
                yield m.start(), end + len(re.match("=" * (-letters % 4) + "|", text[end : end + 2])[0])


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key file: magic, then cipher, derivation, options and a count of one or more."""
    if not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data) and int.from_bytes(data[at : at + 4], "big") >= 1


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    """Header and payload are JSON objects in base64url, the header names an algorithm, and a signature follows."""
    try:
        head, body = (
            json.loads(base64.b64decode(x.replace("-", "+").replace("_", "/") + "=" * (-len(x) % 4), validate=True))
            for x in (header, payload)
        )
    except (ValueError, RecursionError):
        return False
    if not (isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)):
        return False
    return bool(signature) or head["alg"].lower() == "none"


def base_spans(text: str) -> list[Span]:
    lower = text.lower()
    found: list[Span] = []
    if any(part in lower for part in ASSIGN_PARTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            datas = list(_bytes_of(re.sub(r"\\[nr]|\s", "", m[3])))
            # with a DEK-Info line the body is encrypted, in whole blocks
            sealed = "DEK-Info:" in m[2] and any(len(d) >= SMALLEST_KEY and len(d) % 8 == 0 for d in datas)
            if sealed or any(is_der_key(d) or is_ssh_key(d) for d in datas):
                found.append(("pem", *m.span()))
    if "." in text:
        found += [("token", *m.span()) for m in TOKEN.finditer(text) if is_signed_token(*m.groups())]
    for m in ENCODED.finditer(text):
        for data in _bytes_of(m[0]):
            if is_der_key(data):
                found.append(("der", *m.span()))
            elif is_ssh_key(data):
                found.append(("ssh", *m.span()))
    taken = list(found)
    found += [("der", a, b) for a, b in _embedded_keys(text) if not any(start <= a and b <= end for _, start, end in taken)]
    return found


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered(spans))


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with each run of overlapping spans replaced by a mark that names the first kind."""
    parts, done, until = [], 0, -1
    for kind, start, end in ordered(spans):
        if start >= until:
            parts += [text[done:start], f"[{kind.upper()} REMOVED]"]
        done = until = max(until, end)
    return "".join([*parts, text[done:]])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        counts, digests, spans = [], [], []
        for text in batch.column("text").to_pylist():
            base = base_spans(text or "")
            kinds = [s[0] for s in base]
            counts.append([kinds.count(k) for k in BASE])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + confirmed_spans(text or "")))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE))),
             pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )


def secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind; base_sha256
    covers those of the base kinds.  A NULL text is empty: no spans, and the digest of an empty string.
    A NULL doc_id and rows that repeat one are scanned like others; no other column is read.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text) + confirmed_spans(text) if text else []
            texts.append(redacted(text, spans) if spans else text)
        at = batch.schema.get_field_index("text")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1 :]], batch.schema.names
        )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with all their columns; every secret in ``text`` is replaced by a mark.  NULL stays NULL."""
    return docs.mapInArrow(_clean, docs.schema)
