"""Reference sequences from FASTA files, cut into chunks without passing a file or a chromosome through one task.

Lines are read split by split. A line's record and its place in it follow from the headers and bases before it in its own
split, plus what the splits before carry over: the last header and how many bases stand behind it, one row a split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SIZE, FLANK = 500, 5
#: Bases of a line that are handled at a time.
PIECE = 1 << 16


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, split (where the block begins), nth (orders the lines of a split), name (of headers) and bases (of others)."""
    text = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"), F.regexp_replace("value", r"\s+$", "").alias("line"))
    header = F.startswith("line", F.lit(">"))
    name = F.when(header, F.regexp_extract("line", r"^>\s*(\S*)", 1))
    return text.where((F.col("line") != "") & ~F.startswith("line", F.lit(";"))).select("file", "split", "nth", name.alias("name"), F.when(~header, F.regexp_replace("line", r"\s+", "")).alias("bases"))


def _carried(placed: DataFrame) -> DataFrame:
    """file, split, and what is open where it begins: name, and length of the bases read so far."""
    # The last header of a split and the bases behind it; without a header, all its bases.
    last = placed.groupBy("file", "split").agg(F.max("record").alias("last"), F.max_by("name", F.when(F.col("name").isNotNull(), F.col("nth"))).alias("name"), F.sum(F.length("bases")).alias("all"))
    behind = placed.join(last.select("file", "split", "last"), ["file", "split"]).where("record = last").groupBy("file", "split").agg(F.coalesce(F.sum(F.length("bases")), F.lit(0)).alias("behind"))
    splits = last.join(behind, ["file", "split"])
    # One row a split: a file of a terabyte has some thousand.
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    group = F.coalesce(F.sum(F.when(F.col("name").isNotNull(), 1).otherwise(0)).over(before), F.lit(0))
    opened = splits.select("*", F.last("name", ignorenulls=True).over(before).alias("open"), group.alias("group"))
    # Splits of one group have the same header open; the one with that header opens the sum.
    sums = Window.partitionBy("file", "group").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opener = opened.where("name IS NOT NULL").select("file", (F.col("group") + 1).alias("group"), F.col("behind").alias("first"))
    so_far = opened.select("file", "split", "open", "group", F.coalesce(F.sum("behind").over(sums), F.lit(0)).alias("since"))
    return so_far.join(opener, ["file", "group"], "left").select("file", "split", "open", (F.coalesce("first", F.lit(0)) + F.col("since")).alias("carried"))


def read_fasta(spark: SparkSession, paths: str | list[str], size: int = SIZE, flank: int = FLANK) -> DataFrame:
    """chrom (a header's first word), chunk and seq: upper-case bases chunk * size + 1 to (chunk + 1) * size with `flank`
    more at either end, as `reference_context` takes them.

    Records may span lines, splits of any size and, in a file, any number of each; a line may be a whole chromosome. Empty lines, blanks and
    comment lines (;) don't count; bases in front of the first header are dropped; a record without bases has no chunk. A name that
    occurs twice is an error of the file: its chunks are those of the first record in order of file and place.
    """
    lines = _lines(spark, [paths] if isinstance(paths, str) else paths)
    # The lines of a split, which is as long as the reader's largest partition.
    within = Window.partitionBy("file", "split").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.withColumn("record", F.count("name").over(within))
    of_record = Window.partitionBy("file", "split", "record").orderBy("nth")
    placed = placed.withColumns({"own": F.first("name").over(of_record), "upto": F.coalesce(F.sum(F.length("bases")).over(of_record.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    joined = placed.where("bases IS NOT NULL").join(_carried(placed), ["file", "split"])
    first = F.col("record") == 0
    at = joined.select("file", "split", F.when(first, F.col("open")).otherwise(F.col("own")).alias("chrom"), F.col("nth"), (F.col("upto") + F.when(first, F.col("carried")).otherwise(0)).alias("at"), F.upper("bases").alias("bases")).where("chrom IS NOT NULL")
    pieces = at.select("chrom", "at", F.struct("file", "split").alias("source"), F.posexplode(F.regexp_extract_all("bases", F.lit(f".{{1,{PIECE}}}"), F.lit(0))).alias("k", "piece")).select("chrom", "source", (F.col("at") + F.col("k") * PIECE).alias("at"), "piece")
    return _chunks(pieces, size, flank)


def _chunks(pieces: DataFrame, size: int, flank: int) -> DataFrame:
    """pieces: chrom, source, at (bases before it) and piece."""
    end = F.col("at") + F.length("piece")
    least = F.greatest(F.floor((F.col("at") - flank) / size), F.lit(0))
    touched = pieces.select("*", F.explode(F.sequence(least, F.floor((end - 1 + flank) / size))).alias("chunk"))
    begin, stop = F.greatest(F.col("chunk") * size - flank, F.lit(0)), (F.col("chunk") + 1) * size + flank
    skip = F.greatest(begin - F.col("at"), F.lit(0))
    cut: Column = F.substring("piece", (skip + 1).cast("int"), (F.least(stop, end) - F.col("at") - skip).cast("int"))
    parts = touched.select("chrom", "chunk", (F.col("at") + skip).alias("at"), "source", cut.alias("part"))
    inside = F.max((F.col("at") + F.length("part") > F.col("chunk") * size) & (F.col("at") < (F.col("chunk") + 1) * size)).alias("inside")
    # A chunk has few parts; of two records of one name the first part of each place counts.
    met = parts.groupBy("chrom", "chunk", "at").agg(F.min_by("part", "source").alias("part"))
    joined = met.groupBy("chrom", "chunk").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]), "").alias("seq"), inside)
    return joined.where("inside").select("chrom", "chunk", "seq")
