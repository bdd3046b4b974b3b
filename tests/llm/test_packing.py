"""Packing: ids as the tokenizer gives them, cuts against an exhaustive search, whole output against the contract."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cytoflux.llm import packing, queries

PATH = public_tokenizers.path(packing.TOKENIZER)
TEXTS = [None, "", " \n\t", "a", "x" * 3000, "One. Two! Three? " * 400, "no end " * 3000, "é½²Ⅷ ok.\n\n", "中文 字。 ok", "x<|endoftext|>y", "'s'll'x    y", "🙂 " * 700]


def plain_ids(texts):
    t = Tokenizer.from_file(PATH)
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for x in texts]


def test_ids_are_the_tokenizers():
    odd = [f"a{chr(c)} {chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}\n {chr(c)}" for c in [*range(0x3000), *range(0xFE00, 0xFF70)]]
    texts = [t or "" for t in TEXTS] + odd
    for got, want in zip(packing.Encoder.of(PATH).encode(texts), plain_ids(texts), strict=True):
        assert got.tolist() == want.tolist()


def test_forgotten_pieces(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder, texts = packing.Encoder(PATH), ["one two three four", "two three", "five six seven eight nine"]
    for _ in range(2):
        assert [encoder.encode([t])[0].tolist() for t in texts] == [i.tolist() for i in plain_ids(texts)]


def least_cost(p, cost, size):
    """Every place against every earlier one."""
    best = [0]
    for j in range(1, len(p)):
        lengths = [(int(p[j] - p[i]), best[i]) for i in range(j) if p[j] - p[i] <= size]
        best.append(min(b + (0 if n & (n - 1) == 0 else size - n) for n, b in lengths) + int(cost[j]) + packing.WINDOW)
    return best[-1]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([16, 64, 100]))
    p = np.r_[0, np.cumsum(rng.integers(1, size // 2, 80))]
    cost = np.r_[0, rng.integers(0, 12, 80)]
    cuts = packing.cheapest(p, cost, size, True)
    lengths = np.diff(cuts)
    assert cuts[0] == 0 and cuts[-1] == p[-1] and set(cuts) <= set(p) and 0 < lengths.min() and lengths.max() <= size
    paid = sum(0 if n & (n - 1) == 0 else size - n for n in lengths.tolist()) + packing.WINDOW * len(lengths) + int(cost[np.searchsorted(p, cuts[1:])].sum())
    assert paid == least_cost(p, cost, size)


def check(rows, documents, size=1024):
    """documents: (doc_id, ids), each distinct. Returns the padding's share."""
    assert len(rows) == len(set(rows))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for doc_id, start, length, crc, total, sequence, offset in rows:
        sequences[sequence].append((offset, length))
        pieces[doc_id].append((start, length, crc, total))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    for doc_id, ids in documents:
        at = 0
        for start, length, crc, total in sorted(pieces.pop(doc_id)):
            assert start == at and total == len(ids) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    assert not pieces
    used = [sum(n for _, n in parts) for parts in sequences.values()]
    padding = sum(0 if n & (n - 1) == 0 else size - n for n in used)
    return padding / (padding + sum(used))


@pytest.mark.parametrize("segment", [packing.SEGMENT, 5000])
def test_query(spark, segment):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    documents = [(r.doc_id, r.text) for r in docs.collect()]
    ids = list(zip([d for d, _ in documents], plain_ids([t for _, t in documents]), strict=True))
    rows = [tuple(r) for r in packing.pack(docs, segment=segment).collect()]
    assert check(rows, ids) < 0.02
    if segment == packing.SEGMENT:
        query = queries.op13_packing(spark, "/root/testdata/sf0.001")
        assert query.columns == packing.COLUMNS and [t for _, t in query.dtypes] == ["bigint"] * 7
        assert sorted(rows) == sorted(map(tuple, query.collect()))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "mine", 7) for i, t in enumerate(TEXTS)], "doc_id long, text string, start string, `offset` int")
    rows = [tuple(r) for r in packing.pack(docs).collect()]
    check(rows, list(enumerate(plain_ids(TEXTS))))
    repeated = spark.createDataFrame([(None, "a b."), (None, "a b."), (1, None), (1, None), (1, "x")], "doc_id long, text string").coalesce(1)
    got = packing.pack(repeated).collect()
    assert [(r.doc_id, r.doc_tokens) for r in got] == [(None, 4), (None, 4), (1, 1), (1, 1), (1, 2)] and len({r.sequence_id for r in got}) <= 2
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, size=100)


def test_a_very_long_text(spark):
    text = "word " * 300_000 + "z" * 200_000
    rows = [tuple(r) for r in packing.pack(spark.createDataFrame([(1, text), (2, "end")], "doc_id long, text string").coalesce(1), segment=1 << 17).collect()]
    assert check(rows, [(1, packing.Encoder.of(PATH).encode([text])[0]), (2, plain_ids(["end"])[0])]) < 0.01
