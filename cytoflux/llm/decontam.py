"""Benchmark decontamination as a prefix-filtered set join.

Each window of an item is a set of shingles that must all occur, so its prefix is one shingle: the rarest over
all documents. Documents join the windows on that shingle; its place in the window gives the one place where the
window can begin (positional bound), which must lie inside the document (length bound); the words there are then
compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.common import ascii_lower, cut, fresh

#: Java regex of the separators between words, after A-Z were lowered, and of a word before that.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW, SHINGLE = 13, 3
#: Windows up to this many are broadcast (some 100 MB); more are joined by a shuffle.
BROADCAST_WINDOWS = 500_000


def item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def windows_of(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item_id, words: each run of `window` words of an item, or all words of an item that has fewer but not none."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), item_words(F.col("text")).alias("words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    items = items.where(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("start"))
    return items.select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("words")).distinct()


def _at_each_place(df: DataFrame, k: int) -> DataFrame:
    """df, which has `words`, once for each k-word shingle, with its place `at` and its hash `h`."""
    n = F.greatest(F.size("words") - (k - 1), F.lit(0))
    shifted = [F.slice("words", F.lit(j + 1), n).alias(f"w{j}") for j in range(k)]
    out = df.select("*", F.posexplode(F.arrays_zip(*shifted)).alias("at", "s"))
    return out.withColumn("h", F.xxhash64(*[f"s.w{j}" for j in range(k)])).drop("s")


def _found(places: DataFrame, windows: DataFrame, k: int, broadcast_windows: int) -> DataFrame:
    """key, start, end, window_id: where the windows, all of k-word shingles, occur in places (key, words)."""
    small = windows.count() <= broadcast_windows
    hint = F.broadcast if small else lambda df: df
    own = _at_each_place(windows, k)
    seen = _at_each_place(places.select("words"), k).select("h").join(hint(own.select("h").distinct()), "h").groupBy("h").agg(F.count("*").alias("n"))
    # Windows of which a shingle occurs nowhere fall out here.
    ranked = own.join(seen, "h", "left").groupBy("window_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "h")).alias("rarest"))
    rarest = ranked.where("rarest.n > 0").select("window_id", F.col("rarest.at").alias("offset"), F.col("rarest.h").alias("h"))
    rarest = cut(rarest.join(windows.withColumnRenamed("words", "window_words"), "window_id"))
    start, length = F.col("at") - F.col("offset"), F.size("window_words")
    same = F.slice("words", F.greatest(start, F.lit(0)) + 1, length) == F.col("window_words")
    if small:
        met = _at_each_place(places, k).join(F.broadcast(rarest), "h").where((start >= 0) & (start + length <= F.size("words"))).where(same)
    else:
        # Too many to broadcast: only places meet in the shuffle, and the words of documents with candidates join afterwards.
        met = _at_each_place(places, k).select("key", "at", "h", F.size("words").alias("n_words")).join(rarest, "h")
        met = met.where((start >= 0) & (start + length <= F.col("n_words"))).drop("n_words").join(places.dropDuplicates(["key"]), "key").where(same)
    return met.select("key", start.alias("start"), (start + length).alias("end"), "window_id")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """key (md5 of the text), n_hit, n_items and items_sha256 of each text in which a window of an item occurs."""
    owned = cut(windows_of(items, window).withColumn("window_id", F.md5(F.array_join("words", " "))))
    windows = owned.select("window_id", "words").distinct()
    places = docs.select(text_key(F.col("text")).alias("key"), item_words(F.col("text")).alias("words"))
    k_of = F.least(F.size("words"), F.lit(SHINGLE))
    lengths = [r[0] for r in windows.select(k_of.alias("k")).distinct().collect()] or [SHINGLE]  # SHINGLE rows at most
    found = cut(reduce(DataFrame.union, [_found(places, windows.where(k_of == k), k, broadcast_windows) for k in lengths]))

    spans = found.groupBy("key", "start").agg(F.max("end").alias("end")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct((a["n"] + F.greatest(x["end"] - F.greatest(x["start"], a["upto"]), F.lit(0))).alias("n"), F.greatest(x["end"], a["upto"]).alias("upto")), lambda a: a["n"].cast("long"))
    hits = spans.select("key", covered.alias("n_hit"))
    named = found.select("key", "window_id").distinct().join(owned.select("window_id", "item_id"), "window_id").select("key", "item_id").distinct()
    named = named.groupBy("key").agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item_id")), ","), 256).alias("items_sha256"))
    return hits.join(named, "key")


def _counted(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    """A word is hit, and 5 % or more of the words are."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The rows of docs that are not contaminated (see `judge_documents`), with all their columns as they are.

    Null and empty texts, and texts that only share a few words with an item, stay; repeated rows share a fate; very
    long texts are searched whole; an empty benchmark leaves everything; an empty table gives no rows.
    """
    hits = contamination(docs, items, window, broadcast_windows)
    key, found, n_hit = fresh(docs, "key_of_text", "key_found", "n_hit")
    hits = hits.select(F.col("key").alias(found), F.col("n_hit").alias(n_hit))
    out = docs.withColumn(key, text_key(F.col("text"))).join(hits, F.col(key) == F.col(found), "left")
    # Words are counted where there is a hit alone.
    return out.where(~_contaminated(F.coalesce(n_hit, F.lit(0)), _counted())).select(*[F.col(f"`{c}`") for c in docs.columns])


def judge_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    A document is contaminated if a word is hit and hit words are 5 % or more of its words. Null and empty texts
    have no words and no hits; an empty benchmark hits nothing; items without words occur nowhere; repeated rows
    each get the result of their text; very long texts are searched whole. Items without an id share the empty id.
    Other columns of docs play no part. An empty table gives no rows.
    """
    hits = contamination(docs, items, window, broadcast_windows)
    counted = docs.select("doc_id", text_key(F.col("text")).alias("key"), _counted().alias("n_words"))
    # Texts are counted before the join and don't travel.
    out = counted.join(hits, "key", "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"), "n_items": F.coalesce("n_items", F.lit(0)).cast("long"), "items_sha256": F.coalesce("items_sha256", F.sha2(F.lit(""), 256))})
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", _contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))
