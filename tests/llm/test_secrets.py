"""Secret scans of crafted texts: signed tokens, deep nesting, and long runs that must take linear time."""

from __future__ import annotations

import base64
import json
import time

import pytest

from cytoflux.llm import secrets

MB = 1_000_000


def coded(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(header: object, claims: object = {"sub": "1"}, signature: str = "c2ln") -> str:  # noqa: B006
    return f"{coded(json.dumps(header, separators=(',', ':')).encode())}.{coded(json.dumps(claims, separators=(',', ':')).encode())}.{signature}"


def found(text: str) -> list[tuple[int, str, int]]:
    return [(a, secrets.KINDS[k], b) for a, k, b in secrets.scan(text, secrets.automaton())]


def test_signed_tokens():
    good, unsigned, nameless = token({"alg": "HS256"}), token({"alg": "none"}, signature=""), token({"typ": "JWT"})
    assert found(f"é {good} x") == [(2, "jwt", 2 + len(good))]
    assert found(unsigned) == [(0, "jwt", len(unsigned))]
    assert found(nameless) == [] and found(good.rsplit(".", 1)[0]) == [] and found(good.replace(".", " ")) == []
    assert found(good.lower()) == [] and found("eyJ.eyJ.") == [] and found("eyJhbGci.eyJ.x") == [] and found("eyJ") == []
    assert found(f"{good} {nameless} {unsigned}") == [(0, "jwt", len(good)), (len(good) + len(nameless) + 2, "jwt", len(good) + len(nameless) + 2 + len(unsigned))]
    # A part that heads no token may be followed by a token.
    assert found(f"eyJx.{good}") == [(5, "jwt", 5 + len(good))]



NESTED = f"{coded(b'{"a":' * 200_000)}.eyJhIjoxfQ.x"
LONG = {
    "nested": NESTED,
    "nested list": f"{coded(b'{"a":' + b'[' * 300_000)}.eyJhIjoxfQ.x",
    "eyJ": "eyJ" * (MB // 3),
    "eyJ.": "eyJ." * (MB // 4),
    "eyJx.": "eyJx." * (MB // 5),
    "eyJ without claims": "eyJ" * (MB // 6) + "." + "eyJ" * (MB // 6),
    "AKIA": "AKIA" * (MB // 4),
    "akia": "akia" * (MB // 4),
    "keywords": "secret" * (MB // 6),
    "keywords and spaces": "token" + " " * MB,
    "keywords, colons": "token:" * (MB // 6),
    "quotes": "password='" * (MB // 10),
    "hex": "0123456789abcdef" * (MB // 16),
    "short hex": "0123456789abcdef0123456x" * (MB // 24),
    "ghp_": "ghp_" * (MB // 4),
    "other letters": "é secret=abcdefgh " * (MB // 20),
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_take_linear_time(name):
    start = time.process_time()
    found(LONG[name])
    assert time.process_time() - start < 2


def test_nested_header_in_spark(spark):
    docs = spark.createDataFrame([(1, NESTED), (2, f"key {token({'alg': 'HS256'})}")], "doc_id long, text string")
    rows = {r.doc_id: r.spans for r in secrets.report(docs).collect()}
    assert "jwt" not in rows[1] and rows[2].startswith("jwt:4:")
    assert {r.doc_id: r.text for r in secrets.redact(docs).collect()} == {1: NESTED, 2: f"key {secrets.MASK}"}
