"""Mixing sources to target weights with hash-threshold histograms.

The words of each source are summed by hash bucket; the cumulated sums give the bucket in which a source's
budget ends, only that bucket is split again by the next bits of the hash, and so on; the documents below the
threshold are taken. No document is sorted or sent to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.llm.common import SPACES, cut, fresh

#: Bits of the hash that each histogram looks at, and nested histograms.
BITS, LEVELS = 10, 3
#: Tables of one row per source are broadcast up to this many sources (some 100 MB), so that documents don't travel.
BROADCAST_SOURCES = 1_000_000
WEIGHTS = (1, 2, 3)
MOST = 3


def word_count(text: Column) -> Column:
    """Runs of other characters than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACES.replace("[", "[^"))), F.lit(0)).cast("long")


def mix_key(doc_id: Column, text: Column) -> Column:
    """The top LEVELS * BITS bits of an MD5 of id and text: the same in every run and on every cluster."""
    md5 = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")))))
    return F.shiftright(F.conv(F.substring(md5, 1, 8), 16, 10).cast("long"), 32 - LEVELS * BITS)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size and target.

    Sources in order of code points, null last, weigh `weights` in turn and share all words; a target stops at
    `most` times its source's size and the excess is shared again by weight until none is above. In closed form:
    target = min(weight * level, most * size), where the level follows from the sources in order of the ratio
    at which they stop. The two windows order one row per source, not documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = by_source.withColumn("weight", weight).withColumns({"cap": F.col("source_size") * most, "ratio": F.col("source_size") * float(most) / F.col("weight")})
    stops = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before, rest = stops.rowsBetween(Window.unboundedPreceding, -1), stops.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = ranked.withColumn("rank", F.row_number().over(stops)).withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest))
    # The first source in that order which the level of the rest does not lift over its cap sets the level.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("rank", "level"))).over(everything)["level"]
    return ranked.withColumn("level", level).select(
        "source", "source_size", F.when(F.col("level").isNull() | (F.col("weight") * F.col("level") > F.col("cap")), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level")).alias("target")
    )


def _boundary(histogram: DataFrame) -> DataFrame:
    """Per source the first bucket at which the cumulated words reach the budget (left), with the words below it. A
    window holds 2 ** BITS rows at most, however large the source is."""
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = histogram.withColumn("upto", F.col("below") + F.sum("words").over(so_far)).where(F.col("upto") >= F.col("left"))
    edges = reached.groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"), "words", "left")).alias("edge"))
    return edges.select("source", "edge.*")


def _own(df: DataFrame, other: DataFrame, how: str = "inner", small: bool = False) -> DataFrame:
    """df with the row of other that has its source, null included. small: other's size has been checked."""
    other = other.withColumnRenamed("source", "of_source")
    return df.join(F.broadcast(other) if small else other, F.col("source").eqNullSafe(F.col("of_source")), how).drop("of_source")


def mix_plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source: source_size, target, times (how often all its documents go in) and last_h (up to it once more, or null).

    sizes has source, size and h, and should be materialised: a pass for the targets and one for each level read it.
    """
    targets = source_targets(sizes, weights, most)
    # All documents are taken `times` times, and those below the threshold once more.
    targets = targets.withColumn("times", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    targets = cut(targets.withColumn("left", F.col("target") - F.col("times") * F.col("source_size")))

    small = targets.count() <= BROADCAST_SOURCES
    edges = targets.where("left > 0").select("source", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("below"), "left")
    for level in reversed(range(LEVELS)):
        inside = _own(sizes.select("source", "size", "h"), edges, small=small).where(F.shiftright("h", BITS * (level + 1)) == F.col("bucket"))
        histogram = inside.groupBy("source", F.shiftright("h", BITS * level).alias("bucket")).agg(F.sum("size").alias("words"), F.first("below").alias("below"), F.first("left").alias("left"))
        edges = cut(_boundary(histogram))
    # The last hash value is taken if that brings the source nearer to its target.
    over, under = F.col("below") + F.col("words") - F.col("left"), F.col("left") - F.col("below")
    second = edges.select("source", F.when(over <= under, F.col("bucket")).otherwise(F.col("bucket") - 1).alias("last_h"))
    plan = cut(_own(targets, second, "left").select("source", "source_size", "target", "times", "last_h"))
    return F.broadcast(plan) if small else plan


def copies(times: Column, h: Column, last_h: Column) -> Column:
    """How often the mix takes a document."""
    return F.coalesce(times + F.when(h <= last_h, 1).otherwise(0), F.lit(0)).cast("int")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken (words the mix takes, repeats counted).

    A null text has size 0. Rows that agree in id and text share a fate. Sources of size 0 have target 0. An
    empty table gives no rows. Other columns of docs play no part.
    """
    sizes = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("h")))
    out = _own(sizes, mix_plan(sizes, weights, most))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("times"), F.col("h"), F.col("last_h"))).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, with all their columns, plus `copies` (`_copies` where there is one): how often
    each one goes in.

    Documents without a word are not taken; a null source is a source like others. Repeated rows, which agree in id
    and text, share a fate, each as a row. A very long text is counted whole and may alone exceed its source's
    target: it is taken if that is nearer to the target. An empty table gives no rows.
    """
    plan = mix_plan(cut(docs.select("source", word_count(F.col("text")).alias("size"), mix_key(F.col("doc_id"), F.col("text")).alias("h"))), weights, most)
    n, p_source, p_times, p_last_h, p_size, p_h = fresh(docs, "copies", "p_source", "p_times", "p_last_h", "p_size", "p_h")
    plan = plan.select(F.col("source").alias(p_source), F.col("times").alias(p_times), F.col("last_h").alias(p_last_h))
    out = docs.select("*", word_count(F.col("text")).alias(p_size), mix_key(F.col("doc_id"), F.col("text")).alias(p_h)).where(F.col(p_size) > 0)
    out = out.join(plan, F.col("source").eqNullSafe(F.col(p_source))).withColumn(n, copies(F.col(p_times), F.col(p_h), F.col(p_last_h)))
    return out.where(F.col(n) > 0).select(*[F.col(f"`{c}`") for c in docs.columns], n)
