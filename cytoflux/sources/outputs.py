"""What the steps write, as text-ready DataFrames; `tables.write_table` puts them in a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.sources.tables import pack


def base_counts(counts: DataFrame) -> DataFrame:
    """Counts of one cell type, packed; order by #CHROM and POS."""
    return pack(counts).select(F.col("chrom").alias("#CHROM"), F.col("pos").alias("POS"), F.col("ref").alias("REF"), F.lit("DP|NC|CC|BC|BQ|BCf|BCr").alias("INFO"), "info")


def _variants(calls: DataFrame, *more: Column) -> DataFrame:
    of = lambda name: F.concat_ws(",", F.col(f"noncancer.{name}").cast("string"), F.col(f"cancer.{name}").cast("string"))
    return calls.select(F.col("chrom").alias("#CHROM"), F.col("pos").alias("Start"), F.col("pos").alias("End"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"), F.array_join("filters", ",").alias("FILTER"), of("bc").alias("Bc"), of("cc").alias("Cc"), of("vaf").alias("VAF"), of("mcf").alias("MCF"), *more)


def final_calls(final: DataFrame) -> DataFrame:
    """Calls with their final status: the unfiltered table, or the calls if given the passing ones."""
    status = F.when(F.size("final") == 0, "PASS").otherwise(F.array_join("final", ","))
    return _variants(final, status.alias("STEP3FILTER"), F.col("key").alias("INDEX"))


def hccv_calls(candidates: DataFrame) -> DataFrame:
    """High-confidence cancer variants with their status; all candidates or, given `select_hccv`'s rows, the chosen ones."""
    return _variants(candidates, F.col("key").alias("INDEX"), F.lit("PASS").alias("DP_FILTER"), F.col("hccv").alias("HCCV_FILTER"))


def parameters(spark: SparkSession, reads_ab: tuple[float, float], cells_ab: tuple[float, float]) -> DataFrame:
    """One row: the fitted parameters of reads (1) and cells (2), as `tables.read_parameters` reads them."""
    return spark.createDataFrame([(*reads_ab, *cells_ab)], "alpha1 double, beta1 double, alpha2 double, beta2 double")


def genotype_rows(genotypes: DataFrame) -> DataFrame:
    """The long genotype table; `.` where a value is not known, 3 for a mutation state without coverage."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return genotypes.select(
        F.col("chrom").alias("#CHROM"), F.col("pos").alias("Start"), F.col("pos").alias("End"), F.col("ref").alias("REF"), F.col("alt").alias("ALT_expected"), F.col("cb").alias("CB"), F.col("cell_type").alias("Cell_type_observed"),
        F.col("dp").alias("Dp"), F.col("n_alt").alias("ALT"), dot("vaf").alias("VAF"), dot("p").alias("BetaBin"), F.col("status").alias("MutationStatus"), F.coalesce("mutated", F.lit(3)).alias("BinMutationStatus"), F.col("key").alias("INDEX"),
    )


def panel_rows(panel: DataFrame) -> DataFrame:
    return panel.select(F.col("chrom").alias("#CHROM"), F.col("pos").alias("POS"), F.col("n_samples").alias("Num_samples"), F.col("samples").alias("Sample_ids"))


def assignments(clusters: DataFrame, chain: str = "mean", estimator: str = "posterior") -> DataFrame:
    """One row: the clusters of the cells, in order of the cells, on one line."""
    line = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("cell", "cluster"))), lambda c: c["cluster"].cast("string")), " ")
    return clusters.agg(line.alias("Assignment")).select(F.lit(chain).alias("chain"), F.lit(estimator).alias("estimator"), "Assignment")


def genotypes_of_cells(clusters: DataFrame, genotypes: DataFrame) -> DataFrame:
    """mut, cell, theta (rounded to 4 places) and called: each cell has its cluster's profile."""
    return clusters.join(genotypes, "cluster").select("mut", "cell", F.round("theta", 4).alias("theta"), "called")
