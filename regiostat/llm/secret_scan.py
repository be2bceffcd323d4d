"""Operator 7: secrets in texts, confirmed by their structure.

Three base kinds are plain patterns.  The other kinds are candidates in
base64 or hex that are decoded and parsed first: a private key (RSA, DSA, EC,
PKCS 8, encrypted PKCS 8) counts only if its DER encoding nests without a byte
missing or left over, an SSH key only if its length-prefixed fields fill it, a
signed token only if its header and claims are JSON objects that name an
algorithm, an encrypted PEM block only if its headers name the cipher and its
body is whole cipher blocks.

A key in base64 may begin anywhere in a run of such characters and go over
lines: its own length says where it ends.  A token may follow other words and
dots.

Defined cases: a null or empty text has no spans; offsets are code points,
ends are exclusive; spans come in order of start, then kind as listed, then
end; repeated rows are scanned one by one; whole texts are scanned.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in their fixed order; the first three are the base kinds.
KINDS = ["assign", "access", "hex", "pem", "jwt", "der", "ssh"]
BASE_KINDS = KINDS[:3]
SPAN_TYPE = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType()))

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
# Runs of at least 20 and 24 characters: a greedy run that is shorter fails as
# a whole, so asking for the length in the pattern finds the same matches.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# Every match of the run kinds lies inside one of these maximal runs.
RUN = re.compile(r"[A-Za-z0-9+/_.=-]{20,}")
ANY_HEX = re.compile(r"[0-9A-Fa-f]{64,}")
# Parts of a signed token, as pieces of a run between dots.
WHOLE_PART, FIRST_PART = re.compile(r"[A-Za-z0-9_-]{2,}"), re.compile(r"[A-Za-z0-9_-]*")
PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*)PRIVATE KEY-----"
                 r"((?:(?:\s|\\[nr])*[A-Z][A-Za-z-]+:\x20[A-Za-z0-9,\x20-]+(?:\s|\\[nr]))*)"
                 r"([A-Za-z0-9+/=\s\\]+)-----END \1PRIVATE KEY-----")
# Where the base64 of a DER sequence or of an SSH key may begin.
KEY64 = re.compile(r"(?=M[A-I][A-Za-z0-9+/_-]{18}|b3BlbnNzaC1rZXktdjEA)")
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
LINE_END = re.compile(r"[\x20\t]*(?:\r?\n|\\r\\n|\\n)[\x20\t]*(?!-----)")
# The object identifiers of password-based encryption (PKCS 5 and PKCS 12).
SEALED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
SSH_MAGIC = b"openssh-key-v1\x00"


def decode64(text: str) -> bytes:
    """Bytes of base64 in either alphabet, padded or not; empty if it is none."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return b""
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of the DER values that fill ``data`` exactly."""
    at, out = 0, []
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_private_der(data: bytes) -> bool:
    """RSA (PKCS 1), DSA, EC (SEC 1), wrapped (PKCS 8) or encrypted (PKCS 8) private key."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = der_items(data)
    inner = der_items(outer[0][1]) if outer and len(outer) == 1 else None
    tags = [t for t, _ in inner or ()]
    if tags[:9] == [0x02] * 9:  # version, n, e, d, p, q, d mod p-1, d mod q-1, 1/q
        return inner[0][1] in (b"\x00", b"\x01") and len(inner[1][1]) >= 32
    if tags == [0x02] * 6:  # version, p, q, g, y, x
        return inner[0][1] == b"\x00" and len(inner[1][1]) >= 64
    if tags == [0x30, 0x04]:  # how it is encrypted, and the encrypted key
        algorithm = der_items(inner[0][1])
        return (bool(algorithm) and algorithm[0][0] == 0x06 and algorithm[0][1].startswith(SEALED)
                and len(inner[1][1]) >= 16)
    if tags[:2] == [0x02, 0x04]:  # version 1 and the number
        return inner[0][1] == b"\x01" and len(inner[1][1]) >= 16
    if tags[:3] == [0x02, 0x30, 0x04]:  # version, algorithm, wrapped key
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(inner[2][1]) >= 16
    return False


def der_size(start: bytes) -> int:
    """Bytes of the DER sequence that begins so; 0 if none does."""
    if len(start) < 6 or start[0] != 0x30:
        return 0
    if start[1] < 0x80:
        return 2 + start[1]
    n = start[1] & 0x7F
    return 2 + n + int.from_bytes(start[2:2 + n], "big") if 1 <= n <= 3 else 0


def ssh_fields(data: bytes) -> tuple[bool, int]:
    """Whether ``data`` tells where the OpenSSH private key at its start ends
    (three strings, the key count, its public keys, the sealed part), and
    where; else how many bytes would tell more.  0 if it is none."""
    if not data.startswith(SSH_MAGIC):
        return True, 0
    at, fields = len(SSH_MAGIC), 0
    wanted = 3
    while fields < wanted:
        if at + 4 > len(data):
            return False, at + 4
        at += 4 + int.from_bytes(data[at:at + 4], "big")
        fields += 1
        if fields == 3 and wanted == 3:
            if at + 4 > len(data):
                return False, at + 4
            keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
            if not 1 <= keys <= 16:
                return True, 0
            wanted += keys + 1
    return True, at


def is_ssh_key(data: bytes) -> bool:
    return bool(data) and ssh_fields(data) == (True, len(data))


def base64_at(text: str, at: int, most: int) -> tuple[str, int]:
    """Up to ``most`` base64 characters from ``at`` on, over line ends, and the place after the last."""
    parts, n, end = [], 0, at
    while n < most and (m := PIECE.match(text, at, at + most - n)):
        parts.append(m[0])
        n += len(m[0])
        end = m.end()
        line_end = LINE_END.match(text, end)
        if not line_end:
            break
        at = line_end.end()
    return "".join(parts), end


def may_be_key(start: bytes) -> bool:
    """Whether a DER sequence begins whose first value is a version or another sequence."""
    inner = start[2 + (start[1] & 0x7F if start[1] >= 0x80 else 0):]
    return inner[:2] == b"\x02\x01" or inner[:1] == b"\x30"


def key_at(text: str, at: int) -> tuple[str, int] | None:
    """Kind and end of the private key whose base64 begins at ``at``."""
    if text.startswith("M", at):
        start = decode64(base64_at(text, at, 8)[0])
        size = der_size(start)
        if size < 16 or not may_be_key(start):
            return None
        kind = "der"
    else:
        kind, known, size = "ssh", False, 48
        while not known:
            chars = -(-size // 3) * 4
            body = base64_at(text, at, chars)[0]
            known, more = ssh_fields(decode64(body[:len(body) // 4 * 4]))
            if not known and (more <= size or more > len(text) - at or len(body) < chars):
                return None  # the text ends before the key does
            size = more
    need = -(-size * 4 // 3)
    body, end = base64_at(text, at, need) if size and need <= len(text) - at else ("", at)
    if not size or len(body) < need:
        return None
    data = decode64(body)
    if not (is_private_der(data) if kind == "der" else is_ssh_key(data)):
        return None
    stop = end
    while stop < len(text) and stop < end + 2 and text[stop] == "=":
        stop += 1
    return kind, stop


def is_sealed_pem(headers: str, body: bytes) -> bool:
    """A PEM block encrypted the old way: its headers say so, its body is whole cipher blocks."""
    return "ENCRYPTED" in headers and "DEK-Info:" in headers and len(body) >= 16 and len(body) % 8 == 0


def is_signed_token(text: str) -> bool:
    head, claims, signature = text.split(".")
    try:
        header = json.loads(decode64(head))
        body = json.loads(decode64(claims))
    except (ValueError, RecursionError):
        return False
    named = isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict)
    return named and (header["alg"].lower() == "none" or bool(decode64(signature)))


def signed_tokens(text: str, at: int, end: int) -> list[tuple[int, int]]:
    """Signed tokens of a run: each two neighbouring dots may part one.  A header
    may have words and dashes before it: it begins with the part before the
    first dot, or with the first or the last ``eyJ`` in that part."""
    pieces = text[at:end].split(".")
    found, place, reach = [], at, at
    for first, claims, last in zip(pieces, pieces[1:], pieces[2:]):
        begin, place = place, place + len(first) + 1
        head = first[max(map(first.rfind, "+/=")) + 1:]
        if len(head) < 8 or not WHOLE_PART.fullmatch(claims):
            continue
        begin += len(first) - len(head)
        rest = f".{claims}.{FIRST_PART.match(last)[0]}"
        for start in sorted({0, head.find("eyJ"), head.rfind("eyJ")} - {-1}):
            if begin + start >= reach and is_signed_token(head[start:] + rest):
                reach = begin + len(head) + len(rest)
                found.append((begin + start, reach))
                break
    return found


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, in order."""
    if not text:
        return []
    found = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    pem, key_end = [], 0
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            data = decode64(re.sub(r"\\[nr]|\s", "", m[3]))
            if is_private_der(data) or is_ssh_key(data) or is_sealed_pem(m[2], data):
                pem.append(m.span())
        found += [("pem", *s) for s in pem]
    for run in RUN.finditer(text):
        at, end = run.span()
        found += [("access", *m.span()) for m in ACCESS.finditer(text, at, end)]
        found += [("hex", *m.span()) for m in HEX.finditer(text, at, end)]
        if any(a <= at and end <= b for a, b in pem):
            continue
        found += [("jwt", *s) for s in signed_tokens(text, at, end)]
        if end - at >= 64:
            for m in ANY_HEX.finditer(text, at, end):
                if m[0].startswith("30") and len(m[0]) % 2 == 0 and is_private_der(bytes.fromhex(m[0])):
                    found.append(("der", *m.span()))
        for m in KEY64.finditer(text, at, end):
            if m.start() < key_end:
                continue
            key = key_at(text, m.start())
            if key:
                kind, key_end = key
                found.append((kind, m.start(), key_end))
    rank = KINDS.index
    return sorted(set(found), key=lambda s: (s[1], rank(s[0]), s[2]))


_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@F.arrow_udf(SPAN_TYPE)
def _spans(texts: pa.Array) -> pa.Array:
    return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t)] for t in texts.to_pylist()],
                    _ARROW_SPANS)


@F.arrow_udf(T.StringType())
def _masked(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([mask(t, [(s["start"], s["end"]) for s in ss or ()])
                     for t, ss in zip(texts.to_pylist(), spans.to_pylist())], pa.string())


def mask(text: str | None, spans: list[tuple[int, int]], by: str = "[SECRET]") -> str | None:
    """The text with each (merged) span replaced."""
    if not spans or text is None:
        return text
    out, at, reach = [], 0, -1
    for start, end in sorted(spans):
        if start >= reach or reach < 0:
            out += [text[at:start], by]
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _clean(texts: pa.Array) -> pa.Array:
    parts = []
    for at in range(0, len(texts), 256):
        found = texts.slice(at, 256).to_pylist()
        parts.append(pa.array([mask(t, [s[1:] for s in spans_of(t)]) for t in found], pa.string()))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def without_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``: :func:`find_secrets` and :func:`redact` in one pass."""
    return docs.withColumn(text, _clean(F.col(text)))


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secret_spans") -> DataFrame:
    """``docs`` with the column ``out``: array of (kind, start, end)."""
    return docs.withColumn(out, _spans(F.col(text)))


def redact(docs: DataFrame, text: str = "text", spans: str = "secret_spans") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[SECRET]``."""
    return docs.withColumn(text, _masked(F.col(text), F.col(spans)))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def report(found: DataFrame, spans: str = "secret_spans") -> DataFrame:
    """Counts and digests per document of a :func:`find_secrets` result."""
    s = F.col(spans)

    def count(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(s, lambda x: x["kind"].isin(BASE_KINDS))
    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(s).alias("spans"))
