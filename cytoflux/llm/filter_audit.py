"""Audit of how five document filters interact: for every order of the filters, what each step removes.

A document's outcome under any order follows from the set of filters that it fails, so documents are counted by
part, by that set (a mask of five bits) and by their labels, and the 120 orders are walked on the counts alone.

Duplicates are found by refining a partition. Documents are split by their length in code points, then by the hash
of one block of the text after the other, and a document that is alone in its class is dropped from the next round. Where a last
class has equal least and greatest full text all its texts are equal; a class of different texts is split by
the texts themselves. Ids that are not a group's least are marked before masks are counted.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.llm.common import Scratch, SPACES, cut

FILTERS = "ABCDE"
SYMBOLS = r"[#$%&*|]"
#: Blocks of code points (first, how many) whose hashes refine the classes; the last one has no end.
BLOCKS = ((1, 256), (257, 4096), (4353, 1 << 30))


def failures(text: Column) -> Column:
    """Bits of the filters A to D that the text fails; null is as empty.

    A: under 50 words. B: 100 * distinct words < 65 * words. C: 100 * [A-Z] > 5 * code points. D: a symbol.
    """
    text = F.coalesce(text, F.lit(""))
    trimmed = F.trim(text, F.lit(" \t\n\x0b\f\r"))
    return F.transform(
        F.array(F.struct(F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES)).alias("words"), F.length(text).alias("n"), F.length(F.regexp_replace(text, "[^A-Z]+", "")).alias("capitals"), text.rlike(SYMBOLS).alias("symbol"))),
        lambda x: (
            F.when(F.size(x["words"]) < 50, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(x["words"])) < 65 * F.size(x["words"]), 2).otherwise(0)
            + F.when(100 * x["capitals"].cast("long") > 5 * x["n"].cast("long"), 4).otherwise(0)
            + F.when(x["symbol"], 8).otherwise(0)
        ),
    )[0]


def _class_of(text: Column) -> list[Column]:
    """n (code points) and the hashes of the text's blocks."""
    text = F.coalesce(text, F.lit(""))
    return [F.length(text).alias("n"), *(F.xxhash64(F.substring(text, a, n)).alias(f"h{k}") for k, (a, n) in enumerate(BLOCKS))]


def _first_ids(judged: DataFrame, docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Of the texts that occur in several rows: key columns and first_id (the least id that is not null) by class, for
    classes of equal texts; and the same by class and text for the others."""
    keys = ["n", *(f"h{k}" for k in range(len(BLOCKS)))]
    alive = judged
    for k in range(1, len(keys) + 1):
        shared = alive.groupBy(keys[:k]).agg(F.count("*").alias("rows")).where("rows > 1").drop("rows")
        # Counts combine before the shuffle, so that a class of any size is one row of each task.
        alive = alive.join(scratch.cut(shared), keys[:k], "left_semi")
    classes = scratch.cut(alive.groupBy(keys).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")).drop("rows"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_class_of(F.col("text"))).join(classes.select(keys), keys, "left_semi")
    ends = scratch.cut(texts.groupBy(keys).agg((F.min("text") == F.max("text")).alias("equal")))
    equal = cut(classes.join(ends.where("equal"), keys).select(*keys, "first_id"))
    mixed = scratch.cut(ends.where(~F.col("equal")).select(keys))
    by_text = cut(texts.join(mixed, keys, "left_semi").groupBy(*keys, "text").agg(F.min("doc_id").alias("first_id")))
    return equal, by_text


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, part (source; null: empty), mask (bits of the filters failed), good and toxic.

    E: the text is identical to the text of a smaller doc_id. Null and empty texts are identical; a null id is neither smaller nor
    larger than another. Rows that share an id share its labels; an id is good (toxic) if any of its labels is.
    Repeated rows count each; texts of any length are compared whole; other columns are not looked at; an empty table gives no rows.
    """
    keys = ["n", *(f"h{k}" for k in range(len(BLOCKS)))]
    docs = docs.select("doc_id", "text", F.coalesce("source", F.lit("")).alias("part"))
    with Scratch(docs.sparkSession) as scratch:
        judged = cut(docs.select("doc_id", "part", failures(F.col("text")).alias("mask"), *_class_of(F.col("text"))))
        equal, by_text = _first_ids(judged, docs, scratch)
        if by_text.isEmpty():
            first = judged.join(equal, keys, "left").select("doc_id", "part", "mask", "first_id")
        else:  # some class holds different texts: those are joined by their text
            split = by_text.select(keys).distinct()
            texts = docs.select("doc_id", "part", failures(F.col("text")).alias("mask"), F.coalesce("text", F.lit("")).alias("text"), *_class_of(F.col("text"))).join(split, keys, "left_semi")
            alone = judged.join(split, keys, "left_anti").join(equal, keys, "left").select("doc_id", "part", "mask", "first_id")
            first = alone.unionByName(texts.join(by_text, [*keys, "text"], "left").select("doc_id", "part", "mask", "first_id"))
        later = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
        marked = first.select("doc_id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))
        judged_labels = labels.groupBy("doc_id").agg(F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
        out = marked.join(judged_labels, "doc_id", "left")
        return cut(out.select("doc_id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")))


def count_masks(judged: DataFrame) -> DataFrame:
    """part and counts: an array of (mask, n, good, toxic), at most 32 a part."""
    counts = judged.groupBy("part", "mask").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    return counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))


def walk_orders(counts: DataFrame) -> DataFrame:
    """One row per part, filter_order and step; see `audit`."""

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)), F.lit(0))

    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = counts.select("part", "counts", F.explode(F.split(F.lit(",".join(orders)), ",")).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.select("*", bits(F.substr("filter_order", F.lit(1), F.col("step") - 1)).alias("before"), bits(F.substr("filter_order", "step", F.lit(1))).alias("own"))
    fails, earlier = (lambda c: c["mask"].bitwiseAND(F.col("own")) != 0), (lambda c: c["mask"].bitwiseAND(F.col("before")) != 0)

    def total(of, value=lambda c: c["n"]) -> Column:
        return F.aggregate(F.filter("counts", of), F.lit(0).cast("long"), lambda t, c: t + value(c))

    share = lambda c: c["n"] * (F.lit(len(orders)) / F.bit_count(c["mask"])).cast("long")
    removed = lambda c: fails(c) & ~earlier(c)
    return steps.select(
        "part", "filter_order", "step", total(lambda c: ~fails(c) & ~earlier(c)).alias("kept"), total(removed).alias("removed"), total(lambda c: fails(c) & earlier(c)).alias("redundant"),
        total(lambda c: c["mask"] == F.col("own")).alias("unique_fails"), total(removed, lambda c: c["good"]).alias("good_lost"), total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        # In an order a document is removed by the first filter that it fails: each of them is first in as many orders.
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order (the 120 orders of the five filters) and step (1 to 5; its filter is that letter of
    the order), zeros included: kept (documents of the part that this step leaves), removed, redundant (they fail its filter and
    were removed before), unique_fails (they fail its filter alone), good_lost and toxic_lost (removed here with that label), and
    shapley (its filter's removals, summed over all orders). See `judge` for filters, nulls, repeats and ties.
    """
    return walk_orders(count_masks(judge(docs, labels)))
