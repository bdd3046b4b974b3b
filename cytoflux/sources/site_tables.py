"""Tables laid out by site: directories by chromosome and bin of positions, buckets by chromosome and position.

Regions read the directories that they touch. Whatever groups or joins by chrom and pos finds its rows together, so that counting
and genotyping over such tables shuffle nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.operators.intervals import inside

#: Positions of a directory, and buckets in each. Tables that are to be joined without a shuffle agree in the buckets.
WIDTH, BUCKETS = 10_000_000, 64


def write_sites(df: DataFrame, name: str, width: int = WIDTH, buckets: int = BUCKETS) -> None:
    """df (chrom, pos and any others) as the table `name` of the catalog, with a column bin: floor(pos / width).

    Rows are dealt to their buckets once, so that each directory has one file a bucket. Rows without chrom or pos are of no site and are not kept.
    """
    binned = df.where(F.col("chrom").isNotNull() & F.col("pos").isNotNull()).withColumn("bin", F.floor(F.col("pos") / width))
    dealt = binned.repartition(buckets, "chrom", "pos").sortWithinPartitions("chrom", "bin", "pos")
    # A column can't part directories and buckets at once: directories have their own copy of the chromosome.
    parts = dealt.withColumn("of_chrom", F.col("chrom"))
    parts.write.mode("overwrite").format("parquet").option("compression", "zstd").partitionBy("of_chrom", "bin").bucketBy(buckets, "chrom", "pos").sortBy("chrom", "pos").saveAsTable(name)


def read_sites_table(spark: SparkSession, name: str) -> DataFrame:
    """The whole table."""
    return spark.table(name).drop("of_chrom", "bin")


def read_region(spark: SparkSession, name: str, chrom: str, start: int, end: int, width: int = WIDTH) -> DataFrame:
    """Rows with start <= pos < end of one chromosome, from its directories alone."""
    rows = spark.table(name).where((F.col("of_chrom") == chrom) & F.col("bin").between(start // width, (end - 1) // width))
    return rows.where((F.col("pos") >= start) & (F.col("pos") < end)).drop("of_chrom", "bin")


def read_regions(spark: SparkSession, name: str, regions: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows inside any of the regions (chrom, start, end: half-open); Spark prunes the directories by the regions' bins at run time."""
    touched = regions.where("end > start").select(F.col("chrom").alias("of_chrom"), F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))).alias("bin")).distinct()
    rows = spark.table(name).join(touched, ["of_chrom", "bin"], "left_semi").drop("of_chrom", "bin")
    return inside(rows, regions)
