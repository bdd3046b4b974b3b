"""Panels of normals, training data of the beta-binomial, expression counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.functions.alleles import BASES
from cytoflux.functions.betabinom import fit_frame


def panel_of_normals(calls: DataFrame, min_samples: int = 1, strip_chr: bool = False) -> DataFrame:
    """chrom, pos, n_samples, samples of sites with filters in enough samples. calls: sample_id, chrom, pos, filters (null: none)."""
    chrom = F.regexp_replace("chrom", "^chr", "") if strip_chr else F.col("chrom")
    kept = calls.where(F.col("filters").isNotNull()).select(chrom.alias("chrom"), "pos", "sample_id")
    out = kept.groupBy("chrom", "pos").agg(F.count("*").alias("n_samples"), F.array_join(F.sort_array(F.collect_list("sample_id")), ",").alias("samples"))
    return out.where(F.col("n_samples") >= min_samples)


def training_counts(counts: DataFrame) -> DataFrame:
    """dp, nc, alt_reads, alt_cells of rows whose alternative bases are under 15 % of reads and 10 % of cells."""
    other = lambda k: sum((F.when(F.col("ref") == x, 0).otherwise(F.col(k)[i]) for i, x in enumerate(BASES)), F.lit(0))
    out = counts.withColumns({"alt_reads": other("bc").cast("long"), "alt_cells": other("cc").cast("long")})
    return out.where((F.col("alt_cells") / F.col("nc") < 0.10) & (F.col("alt_reads") / F.col("dp") < 0.15)).select("chrom", "pos", "cell_type", "dp", "nc", "alt_reads", "alt_cells")


def sample_per_file(rows: DataFrame, file: str, n: int, seed: int = 1992) -> DataFrame:
    """Exactly n rows of each file, or all of it, in a random order that the seed and the row fix.

    Rows of a file are thinned in parallel first: of each of its 64 slices no more than n can be chosen.
    """
    columns = rows.columns
    keyed = rows.withColumn("order_", F.xxhash64(F.lit(seed), *columns)).withColumn("slice_", F.pmod("order_", F.lit(64)))
    tie = [F.col(c) for c in columns]
    some = keyed.withColumn("nth_", F.row_number().over(Window.partitionBy(file, "slice_").orderBy("order_", *tie))).where(F.col("nth_") <= n)
    return some.withColumn("nth_", F.row_number().over(Window.partitionBy(file).orderBy("order_", *tie))).where(F.col("nth_") <= n).select(*columns)


def fit_beta_binomial(training: DataFrame) -> dict[str, float]:
    """alpha1, beta1 from cell counts and alpha2, beta2 from read counts. Only histograms of single counts reach the driver."""
    a1, b1 = fit_frame(training, "alt_cells", "nc")
    a2, b2 = fit_frame(training, "alt_reads", "dp")
    return {"alpha1": a1, "beta1": b1, "alpha2": a2, "beta2": b2}


def gene_counts(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """gene, cb, n: counts (ensg, cb, n) of the genes (ensg, gene) that have a name, summed over ids of the same name."""
    return counts.join(genes, "ensg").groupBy("gene", "cb").agg(F.sum("n").alias("n"))
