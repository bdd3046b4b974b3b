"""The pipeline's stages against plain versions, each on what the one before kept."""

from __future__ import annotations

import corpus_pipeline
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id: r.text for r in docs.collect()}
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["language_id", "near_duplicates", "decontamination", "secret_scan", "mixing"]

    def step(name):
        nonlocal docs
        docs = named[name](spark, docs, SF)
        assert docs.columns[: len(columns)] == columns
        docs = docs.checkpoint()
        return {r.doc_id: r.text for r in docs.collect()}

    spark.sparkContext.setCheckpointDir("/tmp/cytoflux-test-checkpoints")
    after = step("language_id")
    assert after.items() <= kept.items() and len(after) >= 0.97 * len(kept)

    want = {d for d, (_, _, k) in brute.near(list(after.items()), 5, 80).items() if k}
    kept = step("near_duplicates")
    assert kept == {d: after[d] for d in want}

    judged = brute.contamination(list(kept.items()), items)
    after = step("decontamination")
    assert after == {d: t for d, t in kept.items() if not judged[d][4]}

    kept = step("secret_scan")
    assert kept.keys() == after.keys()
    for d, t in after.items():
        assert brute.secret_base(kept[d])[:3] == (0, 0, 0)
        if brute.secret_base(t)[:3] == (0, 0, 0):
            assert kept[d] == t

    sizes = {d: len(brute.SPACE.findall(t or "")) for d, t in kept.items()}
    source = {r.doc_id: r.source for r in docs.collect()}
    totals: dict = {}
    for d, n in sizes.items():
        totals[source[d]] = totals.get(source[d], 0) + n
    rows = named["mixing"](spark, docs, SF).collect()
    taken = dict.fromkeys(totals, 0)
    for r in rows:
        taken[r.source] += r.copies * sizes[r.doc_id]
        assert 1 <= r.copies <= 3
    target = brute.targets(totals)
    assert all(abs(taken[s] - target[s]) <= max(sizes.values()) for s in totals)


def test_near_duplicates_keep_rows(spark):
    """Repeated rows, rows that share an id but not a text, and groups without an id."""
    long = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    a, b, c, d, e = (long(x) for x in "abcde")
    rows = [(1, a, "s"), (1, a, "r"), (1, a, "s"), (2, f"{a} more", "s")]  # repeated: the least of three rows
    rows += [(3, b, "s"), (9, b, "s"), (9, c, "s"), (10, c, "s")]  # 9 loses to 3 with b, and wins with c
    rows += [(None, d, "s"), (None, d, "s"), (5, e, "s"), (None, e, "s")]  # a group without an id; e's null row loses
    rows += [(7, "", "s"), (7, None, "s"), (None, None, "s"), (None, None, "s")]  # no word: all stay
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF)
    want = [(1, a, "r"), (3, b, "s"), (9, c, "s"), (None, d, "s"), (5, e, "s"), (7, "", "s"), (7, None, "s"), (None, None, "s"), (None, None, "s")]
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)
