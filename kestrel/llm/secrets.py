"""Secret scan: an Aho-Corasick keyword prefilter, anchored expressions near its hits, embedded checksums.

 1. A text's bytes are mapped to classes: letters lose their case, and hexadecimal digits of either case become one
    class.  One automaton over classes then finds the keywords of all kinds in a single pass: words such as
    ``token`` in either case, key prefixes, and any run of 32 hexadecimal digits (32 times their class).
 2. Only at a hit is the kind's own expression tried, anchored at that byte.  A kind's hits come in order, and a hit
    inside the kind's last match is passed over, which gives its leftmost non-overlapping matches.
 3. Kinds beyond the base ones carry a proof of their own: a CRC-32 in base 62 (repository and package tokens),
    base58check (extended private keys), bech32 (file encryption and relay keys), a JSON header (web tokens),
    a length prefix (private keys in PEM armour).  A match that fails its check is dropped.  Long runs of
    upper-case hexadecimal digits, which have no checksum, are taken if letters and digits both occur.

Rows are scanned where they lie (``mapInArrow``, no shuffle), and one row's work is linear in its text.

Offsets are code points, end exclusive.  Defined results: a null or empty text has no spans; each row gives a row, with
whatever doc_id it has; further columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kestrel.llm.common import table

#: In the order in which spans of one start are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "crc_token", "base58_key", "bech32_key", "web_token", "pem_key", "upper_hex")
BASE = ("assign", "access", "hex")

# The expressions of the base kinds (bytes, so that only A-Z have another case).
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")

# Public formats of keys with a check of their own.
CRC_TOKEN = re.compile(rb"(?:gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE58_KEY = re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-Za-z])")
BECH32_KEY = re.compile(rb"(?:AGE-SECRET-KEY-1[QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58}|nsec1[qpzry9x8gf2tvdw0s3jn54khce6mua7l]{58})(?![A-Za-z0-9])")
WEB_TOKEN = re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)")
PEM_KEY = re.compile(rb"-----BEGIN ((?:RSA |EC |DSA |OPENSSH |)PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
UPPER_HEX = re.compile(rb"[0-9A-F]{32,}")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = b"qpzry9x8gf2tvdw0s3jn54khce6mua7l"
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("AKIA",),
    "crc_token": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "base58_key": ("xprv",),
    "bech32_key": ("AGE-SECRET-KEY-1", "nsec1"),
    "web_token": ("eyJ",),
    "pem_key": ("-----BEGIN",),
}
HEX_RUN = 32


# ---------------------------------------------------------------- checksums

def crc_token_ok(m: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before, in base 62."""
    n, out = zlib.crc32(m[1]), bytearray()
    for _ in range(6):
        n, digit = divmod(n, 62)
        out.append(BASE62[digit])
    return bytes(reversed(out)) == m[2]


def base58_ok(m: re.Match) -> bool:
    """Base 58 of a payload and the first four bytes of its double SHA-256."""
    n = 0
    for c in m[0]:
        n = n * 58 + BASE58.index(c)
    raw = n.to_bytes((n.bit_length() + 7) // 8, "big")
    return len(raw) == 82 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_ok(m: re.Match) -> bool:
    """The bech32 polynomial over prefix and data leaves 1."""
    prefix, _, data = m[0].lower().rpartition(b"1")
    check = 1
    for v in [c >> 5 for c in prefix] + [0] + [c & 31 for c in prefix] + [BECH32.index(c) for c in data]:
        top, check = check >> 25, (check & 0x1FFFFFF) << 5 ^ v
        for bit, part in enumerate((0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)):
            if top >> bit & 1:
                check ^= part
    return check == 1


def web_token_ok(m: re.Match) -> bool:
    """The first part is a JSON object that names its algorithm."""
    try:
        head = json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
    except (binascii.Error, ValueError):
        return False
    return isinstance(head, dict) and "alg" in head


def pem_ok(m: re.Match) -> bool:
    """A DER sequence as long as it says, or the magic word of the other key format."""
    try:
        raw = base64.b64decode(b"".join(m[2].split()), validate=True)
    except (binascii.Error, ValueError):
        return False
    if raw.startswith(b"openssh-key-v1\x00"):
        return True
    if len(raw) < 2 or raw[0] != 0x30:
        return False
    more = raw[1] & 0x7F if raw[1] & 0x80 else 0
    return len(raw) == 2 + more + (int.from_bytes(raw[2 : 2 + more], "big") if more else raw[1])


#: Per kind the expression and what a match must pass.
RULES = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 8),
    "access": (ACCESS, lambda m: len(m[0]) >= 16),
    "hex": (HEX, lambda m: len(m[0]) >= 32),
    "crc_token": (CRC_TOKEN, crc_token_ok),
    "base58_key": (BASE58_KEY, base58_ok),
    "bech32_key": (BECH32_KEY, bech32_ok),
    "web_token": (WEB_TOKEN, web_token_ok),
    "pem_key": (PEM_KEY, pem_ok),
    "upper_hex": (UPPER_HEX, lambda m: any(c < 58 for c in m[0]) and any(c > 58 for c in m[0])),
}


# ---------------------------------------------------------------- scan

HEX_CLASS = "\x01"
#: Byte to class: letters without case, hexadecimal digits as one, other printable characters as they are.
CLASSES = bytes(1 if chr(b) in "0123456789abcdefABCDEF" else ord(chr(b).lower()) if 33 <= b < 127 else 0 for b in range(256))


@lru_cache(maxsize=1)
def automaton():
    """Aho-Corasick over class strings; a hit names the kinds and the length of its keyword."""
    import ahocorasick

    found: dict[str, list[str]] = {HEX_CLASS * HEX_RUN: ["run"]}
    for kind, words in KEYWORDS.items():
        for w in words:
            found.setdefault(w.encode().translate(CLASSES).decode("latin-1"), []).append(kind)
    out = ahocorasick.Automaton()
    for key, kinds in found.items():
        out.add_word(key, (len(key), tuple(kinds)))
    out.make_automaton()
    return out


_RUN = re.compile(rb"[0-9A-Fa-f]*")
#: In a run of hexadecimal digits of either case, the parts of one case.
_RUN_PARTS = (("hex", re.compile(rb"[0-9a-f]{32,}")), ("upper_hex", UPPER_HEX))


def scan(data: bytes) -> list[tuple[int, int, int]]:
    """(start, kind's rank, end) in bytes of all secrets, sorted."""
    out: list[tuple[int, int, int]] = []
    done = dict.fromkeys((*KINDS, "run"), 0)
    for last, (length, kinds) in automaton().iter(data.translate(CLASSES).decode("latin-1")):
        at = last + 1 - length
        for kind in kinds:
            if at < done[kind]:
                continue
            if kind == "run":
                done["run"] = end = _RUN.match(data, at).end()
                for part, pattern in _RUN_PARTS:
                    ok = RULES[part][1]
                    out += [(m.start(), KINDS.index(part), m.end()) for m in pattern.finditer(data, at, end) if ok(m)]
                continue
            pattern, ok = RULES[kind]
            if m := pattern.match(data, at):
                done[kind] = m.end()
                if ok(m):
                    out.append((m.start(), KINDS.index(kind), m.end()))
    out.sort()
    return out


def code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if not spans or data.isascii():
        return spans
    at, passed, points = 0, 0, {}
    for p in sorted({x for s in spans for x in (s[0], s[2])}):
        passed += len(data[at:p].decode("utf-8", "replace"))
        at, points[p] = p, passed
    return [(points[a], k, points[b]) for a, k, b in spans]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())])


def find_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans are (kind, start, stop, base), by start, then kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(1).cast(pa.large_binary()), []
            for i in range(0, batch.num_rows, 512):
                for data in texts.slice(i, 512).fill_null(b"").to_pylist():
                    spans.append([{"kind": KINDS[k], "start": a, "stop": b, "base": KINDS[k] in BASE} for a, k, b in code_points(data, scan(data))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(SPAN))], names=["doc_id", "spans"])

    return docs.select("doc_id", F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind:string,start:long,stop:long,base:boolean>>")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in text replaced by its kind in brackets (spans that overlap become one; other columns as they are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for i in range(0, batch.num_rows, 512):
                for data in batch.column(at).slice(i, 512).cast(pa.large_binary()).to_pylist():
                    out, end = [], 0
                    for a, k, b in scan(data or b""):
                        if a >= end:
                            out += [data[end:a], b"[", KINDS[k].encode(), b"]"]
                        end = max(end, b)
                    texts.append(None if data is None else b"".join([*out, data[end:]]).decode("utf-8", "replace"))
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


# ---------------------------------------------------------------- registered query

def op11_secret_scan(spark, sf_dir):
    out = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [_count(kind).alias("n_" + kind) for kind in BASE]
    return out.select("doc_id", *counts, F.sha2(F.encode(span_text(base), "UTF-8"), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
