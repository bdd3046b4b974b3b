"""High-confidence cancer variants and the re-annotation of cells by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.functions.alleles import CHRM_DROPS, HCCV_DROPS, any_tag, variant_key
from cytoflux.operators.calling import close_pairs, major_allele
from cytoflux.plans.params import Hccv, Reannotation


def depth_tag(min_dp: int) -> Column:
    """Of both cell types' counts: NoCov without a row, LowDepth below min_dp, else PASS."""
    ca, no = F.col("ca_counts"), F.col("no_counts")
    return F.when(ca.isNull() | no.isNull(), "NoCov").when((ca["dp"] < min_dp) | (no["dp"] < min_dp), "LowDepth").otherwise("PASS")


def difference_tag(params: Hccv) -> Column:
    ca, no = F.col("cancer"), F.col("noncancer")
    vaf, mcf = ca["vaf"] - no["vaf"], ca["mcf"] - no["mcf"]
    alone = F.when((ca["vaf"] >= params.delta_vaf) & (ca["mcf"] >= params.delta_mcf), "PASS").otherwise("Low VAF/MCF")
    both = (
        F.when(ca["vaf"] < 0.05, "NonSig").when((no["vaf"] > 0.1) & (vaf < 2 * params.delta_vaf), "Heterozygous")
        .when(no["vaf"] > 0.2, "Heterozygous").when(mcf < params.delta_mcf, "LowDeltaMCF").otherwise("PASS")
    )
    return F.when(no.isNull(), alone).otherwise(both)


def hccv_candidates(calls: DataFrame, params: Hccv | None = None) -> DataFrame:
    """Calls in cancer of one allele, deep enough and without excluding tags, with their hccv tag."""
    params = params or Hccv()
    df = major_allele(calls).where("NOT multi").where(depth_tag(params.min_dp) == "PASS")
    is_m = F.col("chrom") == "chrM"
    df = df.where(~F.when(is_m, any_tag(F.col("filters"), CHRM_DROPS)).otherwise(any_tag(F.col("filters"), HCCV_DROPS)))
    return df.withColumn("hccv", difference_tag(params)).withColumn("key", variant_key(F.col("chrom"), F.col("pos"), F.col("alt")))


def select_hccv(calls: DataFrame, params: Hccv | None = None) -> DataFrame:
    """The passing candidates that have no other one nearby."""
    params = params or Hccv()
    good = hccv_candidates(calls, params).where("hccv = 'PASS'")
    return close_pairs(good, "close", params.clust_dist, params.strict_compat).where("NOT close").drop("close")


def reannotate(genotypes: DataFrame, fusion_cells: DataFrame, barcodes: DataFrame, params: Reannotation | None = None) -> DataFrame:
    """barcodes (cb, cell_type) of cells with enough covered sites, with their new cell_type and the one before.

    A cell is cancer if its mutated sites and its fusions are min_fraction or more of its covered sites.
    genotypes: cb, dp, status; fusion_cells: fusion, cb.
    """
    params = params or Reannotation()
    cells = genotypes.groupBy("cb").agg(F.count_if(F.col("dp") > 0).alias("n_covered"), F.count_if(F.col("status") == "PASS").alias("n_mutated")).where(F.col("n_covered") >= params.min_variants)
    fused = fusion_cells.select("fusion", "cb").distinct().groupBy("cb").agg(F.count("*").alias("n_fusions"))
    out = barcodes.join(cells, "cb").join(fused, "cb", "left").withColumn("n_fusions", F.coalesce("n_fusions", F.lit(0)))
    some = F.col("n_mutated") + F.col("n_fusions")
    cancer = (some > 0) & (some / F.col("n_covered") >= params.min_fraction)
    return out.withColumn("before", F.col("cell_type")).withColumn("cell_type", F.when(cancer, "Cancer").otherwise("Non-Cancer"))
