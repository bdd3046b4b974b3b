"""The filter audit against a plain walk over all orders."""

from __future__ import annotations

import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from cytoflux.llm import filter_audit, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    first: dict = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    failed = []
    for d, t, s in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > first.get(t, d)}
        failed.append((s or "", {f for f in fails if fails[f]}, d in good and d is not None, d in toxic and d is not None))
    rows = []
    for part in {f[0] for f in failed}:
        mine, removals = [f for f in failed if f[0] == part], dict.fromkeys("ABCDE", 0)
        of_part = []
        for order in map("".join, permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                removed = [f for f in mine if own in f[1] and not f[1] & set(order[: step - 1])]
                removals[own] += len(removed)
                kept = sum(not f[1] & set(order[:step]) for f in mine)
                redundant = sum(own in f[1] for f in mine) - len(removed)
                of_part.append([part, order, step, kept, len(removed), redundant, sum(f[1] == {own} for f in mine), sum(f[2] for f in removed), sum(f[3] for f in removed)])
        rows += [(*r, removals[r[1][r[2] - 1]]) for r in of_part]
    return sorted(rows)


def tuples(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


def test_query(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = queries.op12_filter_audit(spark, SF)
    assert got.columns == COLUMNS and dict(got.dtypes)["step"] == "int" and {t for c, t in got.dtypes if c not in ("part", "filter_order", "step")} == {"bigint"}
    assert tuples(got) == plain(docs, labels)


def odd_rows():
    rest = " ".join(f"w{i}" for i in range(1200))
    texts = [None, "", " \n", "A b c", "A b c", "A B C #", rest, rest, f"{rest}!", f"{rest[:-1]}x", f"x{rest[1:]}", f"{rest[:300]}x{rest[301:]}", "same " * 80, "same " * 80, "é" * 60, "ſ K " * 50, "\x0b\x0c\r#", "😀 " * 70, "Z" * 1_000_000, "Z" * 1_000_000, rest]
    rows = [(i, t, f"s{i % 2}" if i % 3 else None) for i, t in enumerate(texts)]
    return [*rows, (None, rest, "s1"), (None, None, None), (7, rest, "s0"), (7, "other", "s0"), (3, "A b c", ""), (40, "", "s1")]


LABELS = [(1, 1, 0), (3, 0, 1), (3, 1, None), (7, 1, 1), (6, None, None), (None, 1, 1), (13, 1, 1), (99, 1, 1), (19, 0, 1), (20, 1, 0)]


@pytest.mark.parametrize("collide", [False, True])
def test_odd_rows(spark, collide, monkeypatch):
    if collide:  # texts of one length are one class: only their full comparison tells them apart
        monkeypatch.setattr(filter_audit, "BLOCKS", ((1, 1),))
        monkeypatch.setattr(filter_audit, "_class_of", lambda t: [F.length(F.coalesce(t, F.lit(""))).alias("n"), F.lit(0).cast("long").alias("h0")])
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit("mine") for c in ("part", "mask", "n", "h0", "h1", "first_id", "good", "counts", "equal")})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("part", F.lit("mine"))
    assert tuples(filter_audit.audit(docs, labels)) == plain(rows, LABELS)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert tuples(filter_audit.audit(docs, labels.limit(0))) == plain(rows, [])
