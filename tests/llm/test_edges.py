"""Every operator and every stage on rows that are odd: repeated, without id, text or words, very long, tied, and with
columns that bear the names of helper columns; and on empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cytoflux.llm import chat, decontam, langid, licences, long_repeats, mixing, near_dup, quality, queries, secrets, url_filter

SF = "/root/testdata/sf0.001"
CLASHES = "language found found_secrets p_source p_times p_last_h p_size p_h key node kept_id kept_key n_rows row key_of_text key_found n_hit n_words r id later places root copies of n h".split()
BENCH = "the quick brown fox jumps over the lazy dog and then runs far away from here"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice("the of and house green river walks slowly under old tree with some people near".split()) + str(rng.randrange(900)) for _ in range(n))
    long, other = prose(140_000), prose(60)
    assert min(len(long), 1_000_001) == 1_000_001
    texts = [(1, other), (1, other), (1, prose(60)), (2, other), (None, other), (None, None), (3, None), (4, ""), (5, " \n\t"), (6, "½ ² ①"), (7, long), (8, long), (9, f"{BENCH} {prose(5)}"), (10, f"password = {'x' * 12} {prose(40)}"), (11, "word")]
    rows = [(d, t, "en" if i % 2 else None, f"s{i % 2}" if i % 3 else None, None if t is None else len(t)) for i, (d, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("mine") for c in CLASHES})


def operators(spark):
    bench = spark.createDataFrame([("i1", BENCH), ("i2", None), (None, "")], "item_id string, text string")
    model = licences.train(per_class=20)
    return {
        "op2": lambda d: licences.scan(d, model=model), "op4": mixing.mix, "op5": quality.judge_quality, "op6": secrets.report, "op7": lambda d: decontam.judge_documents(d, bench),
        "op8": langid.report, "op9": lambda d: near_dup.classes(d, k=3, percent=85), "op10": long_repeats.remove_repeats,
    }


@pytest.mark.parametrize("name", ["op2", "op4", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_operators(spark, docs, name):
    run = operators(spark)[name]
    rows = run(docs).collect()
    assert sorted((r.doc_id or 0) for r in rows) == sorted((r.doc_id or 0) for r in docs.select("doc_id").collect())
    assert run(docs.limit(0)).count() == 0
    by: dict = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    if name == "op7":
        assert [r.contaminated for r in by[9]] == [True] and sum(r.contaminated for r in rows) == 1
    if name == "op8":
        assert {r.lang_pred for d in (3, 4, 5, 6) for r in by[d]} == {"und"}
    if name == "op9":
        assert {r.component_id for d in (7, 8) for r in by[d]} == {7} and sum(r.kept for r in by[1]) >= 2 and not by[2][0].kept
    if name == "op10":
        assert all(r.n_removed == r.n_bytes > 1_000_000 for d in (7, 8) for r in by[d]) and by[11][0].n_removed == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, SF)
    assert out.columns[: len(docs.columns)] == docs.columns and len(out.columns) - len(docs.columns) == (name == "mixing")
    rows = out.collect()
    assert rows and all(r[c] == "mine" for r in rows for c in CLASHES)
    if name == "near_duplicates":
        assert sum(r.doc_id == 1 for r in rows) == 2 and not any(r.doc_id in (2, 8) for r in rows)
    if name == "language_id":
        assert not any(r.doc_id in (3, 4, 5, 6) for r in rows)
    if name == "secret_scan":
        assert len(rows) == docs.count() and next(r for r in rows if r.doc_id == 10).text.startswith(secrets.MASK)
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_urls_and_turns(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None), (2, "x" * 1_000_000), (3, f"http://w.org/fr/{'y' * 1_000_000}")], "page_id long, url string")
    pages = pages.withColumns({c: F.lit("mine") for c in ("b_rule", "b_host", "b_path", "b_verdict", "host_of_url", "path_of_url", "Rule", "short", "full")})
    rules = url_filter.rules_frame(spark, queries.RULES)
    rows = url_filter.filter_urls(pages, rules).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in rows) == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow"), (3, "allow")]
    assert all(r.b_rule == r.short == "mine" for r in rows) and url_filter.filter_urls(pages.limit(0), rules).count() == 0
    turns = spark.createDataFrame([(1, 0, "user", "z" * 1_000_000), (1, 0, "user", "z" * 1_000_000), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    turns = turns.withColumns({c: F.lit("mine") for c in ("node", "parent", "score", "depth", "leaf", "i")})
    got = {r.conv_id: r.n_turns for r in chat.digest(chat.format_paths(chat.chain(turns))).collect()}
    assert got == {1: 2, None: 1}


def test_foreign_texts_are_rejected(spark):
    model = langid.train(queries.table(spark, "/root/testdata/sf0.01", "documents"))
    foreign = ["Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει μακριά", "Быстрая коричневая лиса прыгает через ленивую собаку и убегает далеко", "我们今天在公园里散步然后回家吃饭", "xqzjv kwpqz vbxzk qqjzx wvkzq pxzqv kzjqx", "ควายกินหญ้าในทุ่งนาตอนเช้า", "זה משפט בשפה אחרת לגמרי שאינה נלמדת כאן"]
    assert sum(model.predict(t)[2] for t in foreign) >= 5
