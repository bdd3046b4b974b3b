"""Importance resampling against a plain version."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cytoflux.llm import importance, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def features(text, least, most):
    words = WORD.findall(lowered(text))
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, least=1, most=1, percent=10, min_words=20):
    """doc_id, n_features, weight, score and rank of rows (doc_id, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    counted = [(d, *features(t, least, most)) for d, t in docs]
    s, t = Counter(bucket(f) for _, _, fs in counted for f in fs), Counter(bucket(f) for x in target for f in features(x, least, most)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    out = []
    for d, words, fs in counted:
        gain = sum(math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in map(bucket, fs))
        weight = gain // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    eligible = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert tuples(got) == plain(docs, target)


@pytest.mark.parametrize("grams", [(1, 1), (1, 3), (2, 2)])
@pytest.mark.parametrize("slice_", [50, importance.SLICE])
def test_odd_rows(spark, grams, slice_, monkeypatch):
    monkeypatch.setattr(importance, "SLICE", slice_)
    texts = [None, "", " \n", "a", "A a b", "\x00a\x00B\x1f", "one two three " * 30, "x" * 5000, "é Ünï ſ K 𝔘 中文 " * 20, "it's 1,5 a-b", "the quick brown fox " * 40, "rare words stand here " * 6, "big " * 300_000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "one two three " * 30), (None, None), (6, "one two three " * 30), (6, "one two three " * 31), (20, "the quick brown fox " * 41)]
    target = ["the quick brown fox", None, "", "É ünï"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("row", "score", "rank", "n", "bucket", "id", "n_words")})
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = importance.resample(df, goal, *grams, percent=60)
    assert tuples(got) == plain(docs, target, *grams, percent=60)
    assert importance.resample(df.limit(0), goal, *grams).count() == 0
    assert tuples(importance.resample(df, goal.limit(0), *grams, percent=60)) == plain(docs, [], *grams, percent=60)


def test_ranks_over_many_partitions_and_ties(spark):
    rows = spark.range(5000).selectExpr("id AS row", "id % 7 AS doc_id", "10 AS n_features", "id % 3 AS score")
    with importance.Scratch(spark) as scratch:
        got = sorted(tuple(r) for r in importance.number_highest(rows, 2500, scratch).collect())
    want = sorted(range(5000), key=lambda i: (-(i % 3), i % 7, i))[:2500]
    assert got == sorted((row, k + 1) for k, row in enumerate(want))
