"""Half-open genome intervals and neighbours within a distance, by bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def tile(intervals: DataFrame, width: int) -> DataFrame:
    """Consecutive windows of `width` over each interval; the last one may be shorter."""
    starts = F.sequence(F.col("start"), F.col("end") - 1, F.lit(width).cast("long"))
    out = intervals.where("end > start").select("chrom", "end", F.explode(starts).alias("start"))
    return out.select("chrom", "start", F.least(F.col("start") + width, F.col("end")).alias("end"))


def merge(intervals: DataFrame, gap: int = 0, width: int = 50_000) -> DataFrame:
    """Intervals whose distance is at most `gap`, as one; intervals without a start or an end are left out.

    Intervals are dealt by the bin of their start. Only one row a bin is ordered over a whole chromosome: how far the bins
    before reach, and where their last island began.
    """
    rows = intervals.select("chrom", "start", "end").dropna(subset=["start", "end"]).withColumn("bin", F.floor(F.col("start") / width))
    before = Window.partitionBy("chrom").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    reaches = rows.groupBy("chrom", "bin").agg(F.max("end").alias("far")).select("chrom", "bin", F.max("far").over(before).alias("reach"))
    order = Window.partitionBy("chrom", "bin").orderBy("start", "end")
    reach = F.greatest("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    begins = F.when(reach.isNull() | (F.col("start") > reach + gap), F.col("start"))
    rows = rows.join(reaches, ["chrom", "bin"]).withColumn("begins", begins)
    rows = rows.withColumn("island", F.max("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy("chrom", "bin", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    carried = parts.groupBy("chrom", "bin").agg(F.max("island").alias("last")).select("chrom", "bin", F.max("last").over(before).alias("carried"))
    islands = parts.join(carried, ["chrom", "bin"]).withColumn("island", F.coalesce("island", "carried"))
    return islands.groupBy("chrom", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def _binned(df: DataFrame, width: int) -> DataFrame:
    return df.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))


def inside(places: DataFrame, intervals: DataFrame, how: str = "left_semi", width: int = 50_000) -> DataFrame:
    """The rows of places (chrom, pos) with start <= pos < end of an interval; how="left_anti": the others."""
    bins = _binned(intervals.select(F.col("chrom").alias("i_chrom"), "start", "end").where("end > start"), width)
    met = (F.col("chrom") == F.col("i_chrom")) & (F.floor(F.col("pos") / width) == F.col("bin")) & (F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end"))
    return places.join(bins.select("i_chrom", "start", "end", "bin"), met, how)


def overlaps(left: DataFrame, right: DataFrame, width: int = 50_000) -> DataFrame:
    """left with r_start and r_end of each interval of right that it overlaps; each pair once, in the bin where the overlap begins."""
    r = _binned(right.select("chrom", F.col("start"), F.col("end")), width).select("chrom", "bin", F.col("start").alias("r_start"), F.col("end").alias("r_end"))
    met = _binned(left, width).join(r, ["chrom", "bin"]).where((F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end")))
    return met.where(F.col("bin") == F.floor(F.greatest("start", "r_start") / width)).drop("bin")


def overlap_counts(left: DataFrame, right: DataFrame, width: int = 50_000) -> DataFrame:
    """left (distinct) with n: how many intervals of right each one overlaps."""
    n = overlaps(left.select("chrom", "start", "end").distinct(), right, width).groupBy("chrom", "start", "end").agg(F.count("*").alias("n"))
    return left.join(n, ["chrom", "start", "end"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def subtract(left: DataFrame, right: DataFrame, width: int = 50_000) -> DataFrame:
    """What is left of each interval of left outside all intervals of right."""
    merged = merge(right)
    cut = overlaps(left.select("chrom", "start", "end").distinct(), merged, width)
    holes = cut.groupBy("chrom", "start", "end").agg(F.sort_array(F.collect_list(F.struct("r_start", "r_end"))).alias("holes"))
    both = left.select("chrom", "start", "end").distinct().join(holes, ["chrom", "start", "end"], "left")
    holes_ = F.coalesce("holes", F.array().cast("array<struct<r_start:bigint,r_end:bigint>>"))
    begins = F.concat(F.array(F.col("start")), F.transform(holes_, lambda h: h["r_end"]))
    ends = F.concat(F.transform(holes_, lambda h: h["r_start"]), F.array(F.col("end")))
    pieces = both.select("chrom", F.explode(F.arrays_zip(begins.alias("s"), ends.alias("e"))).alias("p"))
    return pieces.select("chrom", F.col("p.s").alias("start"), F.col("p.e").alias("end")).where("end > start")


def neighbours(left: DataFrame, right: DataFrame, distance: int) -> DataFrame:
    """left with r_pos of each place of right on the same chromosome that is 1 to `distance` away: bins of that width, and the two beside."""
    r = right.select("chrom", F.col("pos").alias("r_pos")).distinct().withColumn("bin", F.floor(F.col("r_pos") / distance))
    l_bin = F.floor(F.col("pos") / distance)
    met = left.withColumn("bin", F.explode(F.array(l_bin - 1, l_bin, l_bin + 1))).join(r, ["chrom", "bin"])
    gap = F.abs(F.col("pos") - F.col("r_pos"))
    return met.where((gap > 0) & (gap <= distance)).drop("bin")
