"""Secret scans with structural confirmation.

Base spans come from three patterns. Further spans are reported only after their structure is
confirmed: base64 and hex candidates are decoded and must be a key encoding whose nested
lengths use up all bytes, or hide text with a base secret; PEM blocks must hold such an
encoding; signed tokens must have a header that is a JSON object naming its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, map_arrow
from quizloom.llm.spans import Span, digest, joined

BASE = ["assign", "access", "hex"]
#: Kinds that need confirmation: signed tokens, PEM blocks, public key lines, bare encodings of keys, encoded secrets.
CONFIRMED = ["jwt", "pem", "sshkey", "keyblob", "encoded"]
KINDS = BASE + CONFIRMED

_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Runs in which alone access, hex, base64 and token spans can lie.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{20,}")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_ANY = re.compile(r"(?:[0-9a-f]{2}){12,}|(?:[0-9A-F]{2}){12,}")
_B64 = re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}")
_PART = re.compile(r"[A-Za-z0-9_-]+")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{1,60})-----\s*((?:[A-Za-z0-9-]{1,40}:[^\n]*\n(?:[ \t][^\n]*\n)*)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
_SSH = re.compile(r"(?:ssh-(?:rsa|dss|ed25519)|ecdsa-sha2-nistp(?:256|384|521)) ([A-Za-z0-9+/]{40,}={0,2})")
_OPENSSH = b"openssh-key-v1\x00"


def decode64(s: str) -> bytes | None:
    """Bytes of standard or URL-safe base64 with or without padding; None if it is neither."""
    body = s.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_key(data: bytes) -> bool:
    """Whether data is one DER SEQUENCE, all nested lengths exact, that holds an INTEGER of 8 bytes or more, a BIT STRING or an OCTET STRING of 16 or more."""
    found = False
    work = [(data, 0)]
    first = True
    while work:
        block, depth = work.pop()
        at = 0
        while at < len(block):
            if at + 2 > len(block):
                return False
            tag, n = block[at], block[at + 1]
            at += 2
            if n & 0x80:
                size = n & 0x7F
                if not 1 <= size <= 4 or at + size > len(block):
                    return False
                n = int.from_bytes(block[at : at + size], "big")
                at += size
            if at + n > len(block):
                return False
            if first and (tag != 0x30 or at + n != len(block) or n < 16):
                return False
            first = False
            if tag & 0x20 and depth < 12:
                work.append((block[at : at + n], depth + 1))
            elif tag == 0x02 and n >= 8 or tag in (0x03, 0x04) and n >= 16:
                found = True
            elif tag not in (0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0A, 0x0C, 0x13, 0x14, 0x16, 0x17, 0x18) and not tag & 0xC0:
                return False
            at += n
    return found


def ssh_key(data: bytes) -> bool:
    """Whether data is length-prefixed fields that use it up, the first naming a key type."""
    fields, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return False
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + n > len(data):
            return False
        fields.append(data[at : at + n])
        at += n
    return len(fields) >= 2 and fields[0].startswith((b"ssh-", b"ecdsa-"))


def openssh_key(data: bytes) -> bool:
    """Whether data is a private key file of OpenSSH: cipher, key derivation and its options, the number of keys, as many public keys, and one private block, lengths exact."""
    at = len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if not data.startswith(_OPENSSH):
        return False
    names = [field(), field(), field()]
    if None in names or not names[0] or not names[1] or at + 4 > len(data):
        return False
    count = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= count <= 16:
        return False
    for _ in range(count):
        public = field()
        if public is None or not ssh_key(public):
            return False
    private = field()
    return private is not None and len(private) >= 16 and len(private) % 8 == 0 and at == len(data)


def key_bytes(data: bytes | None) -> bool:
    return data is not None and (openssh_key(data) or der_key(data) or ssh_key(data))


def pem_key(headers: str, body: str) -> bool:
    """Whether a PEM block holds a key: its encoding, or, if the headers say how it is enciphered, whole cipher blocks."""
    data = decode64("".join(body.split()))
    if "DEK-Info:" in headers:
        return data is not None and len(data) >= 64 and len(data) % 8 == 0
    return key_bytes(data)


def tokens(text: str, a: int, b: int) -> list[Span]:
    """Signed tokens within a run: three dotted parts, the first a header; tried from each part on, so names before a token don't hide it."""
    parts, out, k = [m.span() for m in _PART.finditer(text, a, b)], [], 0
    while k + 2 < len(parts):
        (x, x2), (y, y2), (z, z2) = parts[k : k + 3]
        near = text[x2:y] == "." and text[y2:z] == "."
        if near and x2 - x >= 8 and y2 - y >= 4 and z2 - z >= 4 and signed_header(text[x:x2]):
            out.append((x, z2, "jwt"))
            k += 3
        else:
            k += 1
    return out


def hides_secret(data: bytes) -> bool:
    """Whether data is UTF-8 text, of printable characters and white space, with a base span."""
    try:
        plain = data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return False
    return "".join(plain.split()).isprintable() and bool(base_spans(plain))


def signed_header(part: str) -> bool:
    data = decode64(part)
    if not data or data[:1] != b"{":
        return False
    try:
        head = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def _has_word(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in _WORDS)


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    if runs is None:
        runs = [m.span() for m in _RUN.finditer(text)]
    out = []
    if _has_word(text):
        out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    for a, b in runs:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text, a, b) if m.end() - m.start() >= 20]
        out += [(*m.span(), "hex") for m in _HEX.finditer(text, a, b)]
    return out


def confirmed_spans(text: str, runs: list[tuple[int, int]]) -> list[Span]:
    out: list[Span] = []
    if "-----BEGIN " in text:
        out += [(*m.span(), "pem") for m in _PEM.finditer(text) if pem_key(m[2], m[3])]
    if "ssh-" in text or "ecdsa-" in text:
        out += [(*m.span(), "sshkey") for m in _SSH.finditer(text) if key_bytes(decode64(m[1]))]
    inside = lambda a, b: any(x <= a and b <= y for x, y, _ in out)
    for a, b in runs:
        out += tokens(text, a, b)
        for m in _HEX_ANY.finditer(text, a, b):
            if inside(*m.span()):
                continue
            data = bytes.fromhex(m[0])
            if key_bytes(data):
                out.append((*m.span(), "keyblob"))
            elif hides_secret(data):
                out.append((*m.span(), "encoded"))
        for m in _B64.finditer(text, a, b):
            if inside(*m.span()) or (data := decode64(m[0])) is None:
                continue
            if key_bytes(data):
                out.append((*m.span(), "keyblob"))
            elif hides_secret(data):
                out.append((*m.span(), "encoded"))
    return out


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    runs = [m.span() for m in _RUN.finditer(text)]
    base = base_spans(text, runs)
    return base, base + confirmed_spans(text, runs) if runs or "-----BEGIN " in text else base


def _scan(batches):
    for part, texts in blocks(batches):
        rows = []
        for t in texts:
            base, every = scan(t.decode("utf-8", "replace"))
            rows.append((*(sum(s[2] == k for s in base) for k in BASE), digest(joined(base, KINDS)), joined(every, KINDS)))
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3]), pa.array(cols[4])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of docs(doc_id, text).

    A null or empty text has no spans (digest of the empty string). Rows are treated one by one,
    so repeated rows give equal results; other columns are ignored; an empty table gives no rows.
    """
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
