"""Counts of bases and cells per site and cell type.

Reads are aggregated per cell first and then per site, so a deep site is combined before the shuffle, and distinct
cells need no extra expansion.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.functions.alleles import ALLELES, barcode, token_class
from cytoflux.operators.intervals import inside
from cytoflux.plans.params import Counting

SITE = ("chrom", "pos", "ref")
KINDS = ("cc", "bc", "bq", "bcf", "bcr")


def primary() -> Column:
    return ~(F.col("is_secondary") | F.col("is_duplicate") | F.col("is_supplementary"))


def at_most(rows: DataFrame, keys: tuple[str, ...], most: int, buckets: int = 1024) -> DataFrame:
    """rows, with `most` of each key's rows, or all of them: the first ones in an order that a hash of the row fixes.

    Keys are counted first, in an aggregation that combines before the shuffle; only rows of keys with too many are dealt
    to buckets of their hashes, whose counts say which ones stay whole. Rows are numbered in the one bucket that the limit
    falls into, so that no task holds a key.
    """
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_")).where(F.col("n_") > most).select(*keys)
    order = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    deep = rows.join(counted, list(keys), "left_semi").withColumn("order_", order).withColumn("bucket_", F.pmod("order_", F.lit(buckets)))
    sizes = deep.groupBy(*keys, "bucket_").agg(F.count("*").alias("n_"))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)  # rows of buckets, not of keys
    room = sizes.withColumn("room_", most - F.coalesce(F.sum("n_").over(before), F.lit(0))).where("room_ > 0")
    dealt = deep.join(room, [*keys, "bucket_"])
    nth = F.row_number().over(Window.partitionBy(*keys, "bucket_").orderBy("order_", *rows.columns))
    partly = dealt.where("room_ < n_").withColumn("nth_", nth).where("nth_ <= room_")
    kept = dealt.where("room_ >= n_").select(*rows.columns).unionByName(partly.select(*rows.columns))
    return rows.join(counted, list(keys), "left_anti").select(*rows.columns).unionByName(kept)


def pileup(read_base: DataFrame, params: Counting) -> DataFrame:
    """Read bases above the quality limits, with their allele class, without skipped ones and sites of unknown reference."""
    out = read_base.where((F.col("base_qual") >= params.min_bq) & (F.col("map_qual") >= params.min_mq) & (F.col("ref") != "N"))
    if params.max_depth is not None:
        out = at_most(out, ("chrom", "pos"), params.max_depth)
    return out.withColumn("allele", token_class(F.col("raw_base"))).where("allele <> 'NA'")


def count_bases(read_base: DataFrame, params: Counting | None = None, keys: tuple[str, ...] = (), regions: DataFrame | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """keys, chrom, pos, ref, cell_type, dp, nc and, per allele in the order of ALLELES, cc, bc, bq, bcf, bcr (arrays).

    keys: columns that are counted apart, such as the sample, in one pass for all their values. regions and excluded
    (chrom, start, end: half-open) say where to count and where not to; they act before anything is shuffled by site.

    read_base has a cell_type; rows without barcode or cell type, and not primary, are not counted. Sites need
    min_dp tokens and min_ac other than the reference in all, cell types min_dp counted reads and min_cc cells.
    """
    params = params or Counting()
    if regions is not None:
        read_base = inside(read_base, regions)
    if excluded is not None:
        read_base = inside(read_base, excluded, "left_anti")
    piled = pileup(read_base, params)
    used = primary() & F.col("cb").isNotNull() & F.col("cell_type").isNotNull()
    is_ = {x: F.col("allele") == x for x in ALLELES}
    each = [F.count_if(is_[x] & used).alias(f"bc_{x}") for x in ALLELES] + [F.sum(F.when(is_[x] & used, F.col("base_qual"))).alias(f"bq_{x}") for x in ALLELES]
    each += [F.count_if(is_[x] & used & ~F.col("is_reverse")).alias(f"bcf_{x}") for x in ALLELES] + [F.count_if(is_[x] & used & F.col("is_reverse")).alias(f"bcr_{x}") for x in ALLELES]
    cells = piled.groupBy(*keys, *SITE, "cell_type", barcode(F.col("cb")).alias("cb")).agg(F.count_if(used).alias("dp"), F.count("*").alias("tokens"), F.count_if(~F.col("allele").isin("N", "O") & (F.col("allele") != F.col("ref"))).alias("ac"), *each)
    vectors = [F.array(*[(F.count_if(F.col(f"bc_{x}") > 0) if k == "cc" else F.coalesce(F.sum(f"{k}_{x}"), F.lit(0))).cast("long") for x in ALLELES]).alias(k) for k in KINDS]
    counted = cells.groupBy(*keys, *SITE, "cell_type").agg(F.sum("dp").alias("dp"), F.count_if(F.col("dp") > 0).alias("nc"), F.sum("tokens").alias("tokens"), F.sum("ac").alias("ac"), *vectors)
    return counted.where((F.col("tokens") >= params.min_dp) & (F.col("ac") >= params.min_ac) & (F.col("dp") >= params.min_dp) & (F.col("nc") >= params.min_cc) & F.col("cell_type").isNotNull()).drop("tokens", "ac")


def merge_counts(*counts: DataFrame) -> DataFrame:
    """The long form of all cell types' counts; a conflict of references is left to `reference_of`."""
    return reduce(DataFrame.unionByName, counts)


def to_wide(counts: DataFrame, cell_types: list[str], value: str = "dp") -> DataFrame:
    """One row a site and one column a cell type, null where it has no row: a full outer join of the cell types."""
    return counts.groupBy("chrom", "pos").pivot("cell_type", cell_types).agg(F.first(value))


def reference_of(counts: DataFrame) -> DataFrame:
    """chrom, pos and the distinct references of the cell types, the most frequent first, joined by `|`."""
    n = counts.groupBy("chrom", "pos", "ref").agg(F.count("*").alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "ref")))
    return n.groupBy("chrom", "pos").agg(F.array_join(F.transform(ordered, lambda x: x["ref"]), "|").alias("refs"))


def flat(counts: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """The vectors as one column per allele."""
    return counts.select(*[c for c in counts.columns if c not in KINDS], *[F.col(k)[i].alias(f"{k}_{x.lower()}") for k in kinds for i, x in enumerate(ALLELES)])


def frequent_alternative(counts: DataFrame) -> DataFrame:
    """The most frequent alternative allele of each row, ties by name and joined by `|`; null without one."""
    pairs = F.array(*[F.struct(F.lit(x).alias("allele"), F.when(F.col("ref") == x, 0).otherwise(F.col("bc")[i]).alias("n")) for i, x in sorted(enumerate(ALLELES), key=lambda p: p[1])])
    most = F.array_max(F.transform(pairs, lambda p: p["n"]))
    top = F.array_join(F.transform(F.filter(pairs, lambda p: p["n"] == most), lambda p: p["allele"]), "|")
    return counts.withColumn("top_alt", F.when(most > 0, top))
