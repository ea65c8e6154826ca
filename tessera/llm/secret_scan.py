"""Secret scan: Aho-Corasick keyword prefilter, anchored patterns only at the hits, then embedded checksums.

A keyword automaton walks each text once.  Only where it hits are the patterns tried, anchored at the hit.  The kinds
that carry a checksum of their own (``github``, ``npm``: CRC-32 in base 62; ``xprv``: base58check; ``bech32``) count only if the
checksum holds.  Hex runs have no keyword, so their plain character-class scan runs over the text itself.

Defined results: null and empty texts have no spans; texts of any length are scanned whole; offsets are code points with
exclusive ends; repeated rows give repeated results; an empty table gives an empty table; other columns are left alone.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Kinds in the order in which spans of one start are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv", "bech32")

#: Keywords in lower case, with the kind that each announces.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "xprv": "xprv",
    "age-secret-key-1": "bech32",
    "nsec1": "bech32",
}

#: Patterns, each tried only where its keyword starts (``hex`` apart).
PATTERNS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]{24,}"),
    "github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "xprv": re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
    "bech32": re.compile(r"(?:AGE-SECRET-KEY-1[02-9AC-HJ-NP-Z]{58}|nsec1[02-9ac-hj-np-z]{58})(?![A-Za-z0-9])"),
}
MIN_ASSIGN, MIN_ACCESS = 6, 20
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32 = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
BECH32_STEPS = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)

_LOWER = {c: c + 32 for c in range(65, 91)}


def crc_base62(body: str) -> str:
    """CRC-32 of ``body`` in base 62, zero-padded to six digits."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits.rjust(6, "0")


def base58_checked(token: str) -> bool:
    """Whether the last four bytes are the double SHA-256 of the others."""
    number = 0
    for c in token:
        number = number * 58 + BASE58.index(c)
    raw = number.to_bytes(82, "big") if number.bit_length() <= 656 else b""
    return bool(raw) and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_checked(token: str) -> bool:
    """Whether the six checksum characters of a bech32 string hold."""
    prefix, _, data = token.lower().rpartition("1")
    state = 1
    for value in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *(BECH32.index(c) for c in data)]:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ value
        for bit, step in enumerate(BECH32_STEPS):
            if top >> bit & 1:
                state ^= step
    return state == 1


def _accepts(kind: str, found: re.Match) -> bool:
    if kind == "assign":
        return len(found[2]) >= MIN_ASSIGN
    if kind == "access":
        return len(found[0]) >= MIN_ACCESS
    if kind in ("github", "npm"):
        return crc_base62(found[1]) == found[2]
    if kind == "xprv":
        return base58_checked(found[0])
    return bech32_checked(found[0])


def build_automaton():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        machine.add_word(word, (len(word), kind))
    machine.make_automaton()
    return machine


def scan_text(text: str | None, machine) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans, by start, then by kind as listed."""
    if not text:
        return []
    spans = [(m.start(), m.end(), "hex") for m in PATTERNS["hex"].finditer(text)]
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(_LOWER)  # a letter that grows in lower case would shift the offsets
    reached: dict[str, int] = {}
    for start, kind in sorted((last - size + 1, kind) for last, (size, kind) in machine.iter(low)):
        if start >= reached.get(kind, 0) and (found := PATTERNS[kind].match(text, start)):
            reached[kind] = found.end()
            if _accepts(kind, found):
                spans.append((start, found.end(), kind))
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    return spans


SPANS_TYPE = "array<struct<start:int,end:int,kind:string>>"


def scan_secrets(docs: DataFrame, text_col: str = "text", out_col: str = "secret_spans") -> DataFrame:
    """``docs`` with ``out_col``: the array of (start, end, kind) spans of each text, empty where there are none.

    A column of that name is replaced.
    """
    small_batches(docs.sparkSession)

    @F.udf(SPANS_TYPE, useArrow=True)
    def spans(text):
        return _scan_one(text)

    return docs.withColumn(out_col, spans(F.col(text_col)))


_machine = None


def _scan_one(text: str | None) -> list[tuple[int, int, str]]:
    global _machine
    if _machine is None:
        _machine = build_automaton()
    return scan_text(text, _machine)


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digests of the spans: the digest form of :func:`scan_secrets`."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"
    fields = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_checked", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for text in batch.column(1):
                spans = _scan_one(text.as_py())
                kinds = [k for _, _, k in spans]
                counts = [kinds.count(k) for k in KINDS[:3]]
                base = ",".join(f"{k}:{a}:{b}" for a, b, k in spans if k in KINDS[:3])
                for column, value in zip(rows, [*counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for a, b, k in spans), len(kinds) - sum(counts)], strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t.type) for c, t in zip(rows, list(fields)[1:], strict=True)]], schema=fields)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(digest, schema)


def redact_secrets(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mask`` (overlapping spans once) and ``n_chars`` set anew.

    Columns and their order stay; rows with no secret stay as they are; null texts stay null.
    """
    small_batches(docs.sparkSession)

    @F.udf("string", useArrow=True)
    def cleaned(text):
        spans = _scan_one(text)
        if not spans:
            return text
        parts, at = [], 0
        for start, end, _ in spans:
            if start >= at:
                parts += [text[at:start], mask]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    out = docs.withColumn("text", cleaned(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
