"""Secret scans: an Aho-Corasick automaton finds keywords, anchored regular expressions run only where one was hit,
and kinds with an embedded checksum are validated.

Texts are scanned as bytes (A-Z lowered for the automaton), so that character classes are ASCII; spans are given in
code points. Only runs of hex digits have no keyword; their own run pattern finds them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.common import fresh

#: Fixed patterns of the base kinds, and of tokens that end in a checksum.
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
CHECKED = re.compile(rb"(?:gh[pousr]_|npm_)[A-Za-z0-9]{36}(?![A-Za-z0-9])")
#: A part of a signed token: header, claims and signature are parts joined by dots, the first two start with eyJ.
PART = re.compile(rb"[A-Za-z0-9_-]*")
KINDS = ("assign", "access", "hex", "checked", "jwt")
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "jwt": ("eyj",),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MASK = "[secret]"


def checksum_holds(token: bytes) -> bool:
    """The last 6 of the 36 characters behind the prefix are the CRC-32 of the 30 before, in base 62."""
    body = token[4:]
    crc, digits = zlib.crc32(body[:30]), ""
    for _ in range(6):
        crc, r = divmod(crc, 62)
        digits = BASE62[r] + digits
    return digits.encode() == body[30:]


def header_holds(part: bytes) -> bool:
    """The part decodes to a JSON object that names an algorithm (a key that is written "alg", without escapes)."""
    try:
        header = base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4))
        return b'"alg"' in header and "alg" in json.loads(header)
    except (ValueError, TypeError, RecursionError):  # the last: nested deeper than the parser goes
        return False


PATTERNS = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= 6),
    "access": (ACCESS, lambda m: len(m[0]) >= 20),
    "checked": (CHECKED, lambda m: checksum_holds(m[0])),
}


def signed_token(raw: bytes, start: int) -> tuple[int, int]:
    """End of the token that starts there with eyJ, 0 for none, and end of the part that starts there.

    Every eyJ of one part shares the part's end and what follows it, so that a part that fails is looked at once.
    """
    header = PART.match(raw, start).end()
    if header - start < 4 or not raw.startswith(b".eyJ", header):
        return 0, header
    claims = PART.match(raw, header + 1).end()
    if claims - header < 5 or not raw.startswith(b".", claims) or not header_holds(raw[start:header]):
        return 0, header
    return PART.match(raw, claims + 1).end(), header


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def scan(text: str, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end) in code points, in order; of each kind leftmost and without overlaps."""
    raw = text.encode("utf-8", "surrogatepass")
    upto, spans = dict.fromkeys(KEYWORDS, 0), []
    for last, (kind, n) in sorted(keywords.iter(raw.lower().decode("latin-1")), key=lambda x: x[0] - x[1][1]):
        start = last + 1 - n
        if start < upto[kind]:
            continue
        if kind == "jwt":
            if raw.startswith(b"eyJ", start):
                end, header = signed_token(raw, start)
                upto[kind] = end or header
                if end:
                    spans.append((start, KINDS.index(kind), end))
            continue
        pattern, holds = PATTERNS[kind]
        if m := pattern.match(raw, start):
            upto[kind] = m.end()  # a match that doesn't hold still uses up its text
            if holds(m):
                spans.append((start, KINDS.index(kind), m.end()))
    spans += [(m.start(), KINDS.index("hex"), m.end()) for m in HEX.finditer(raw)]
    if len(raw) != len(text) and spans:
        points, at, n = {}, 0, 0
        for edge in sorted({e for s in spans for e in (s[0], s[2])}):
            n += len(raw[at:edge].decode("utf-8", "surrogatepass"))
            at, points[edge] = edge, n
        spans = [(points[a], k, points[b]) for a, k, b in spans]
    return sorted(spans)


FOUND = "spans array<struct<start:bigint,kind:string,end:bigint>>, masked string"


def _scanner(mask: bool):
    @F.pandas_udf(FOUND)
    def scan_texts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        keywords = automaton()
        for texts in batches:
            rows = []
            for text in texts:
                spans = scan(text or "", keywords)
                rows.append(([{"start": a, "kind": KINDS[k], "end": b} for a, k, b in spans], masked(text, spans) if mask else None))
            yield pd.DataFrame(rows, columns=["spans", "masked"])

    return scan_texts


def masked(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each run of overlapping spans replaced; null stays null."""
    if not spans:
        return text
    out, at = [], 0
    for a, _, b in spans:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame, text: str = "text", found: str = "found", mask: bool = False) -> DataFrame:
    """docs plus `found`, a struct of spans (start, kind, end: code points, end exclusive, by start, then kind) and,
    if asked for, the text with all spans masked.

    Null and empty texts have no spans; very long ones are scanned whole. Row by row, without a shuffle; repeated
    rows each get the same result; a column named as `found` is replaced; an empty table gives no rows.
    """
    return docs.withColumn(found, _scanner(mask)(F.col(text)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256 (digest of the base spans) and spans (all)."""
    spans = find_secrets(docs.select("doc_id", "text")).select("doc_id", F.col("found.spans").alias("all"))
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("all", lambda s: s["kind"].isin(*KINDS[:3]))
    return spans.select("doc_id", *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each secret in `text` replaced by `MASK`, and n_chars, where there is one, brought up to date.

    Every row and column stays; null and empty texts, and texts without a secret, are as before, of any length.
    Repeated rows are masked alike. An empty table gives no rows.
    """
    columns, (found,) = docs.columns, fresh(docs, "found_secrets")
    out = find_secrets(docs, found=found, mask=True).withColumn("text", F.col(f"{found}.masked"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.size(f"{found}.spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in columns])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
