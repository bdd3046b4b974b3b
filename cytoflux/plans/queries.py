"""The named queries: adapter tables through the operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.functions import alleles, betabinom
from cytoflux.operators import calling, clustering, cohort, fusion, genotype, hccv, intervals, linkage, metrics, pileup, posterior, read_blocks, reads, trees
from cytoflux.plans import adapter
from cytoflux.plans.params import Annotation, Calling, Clustering, Counting, Final, Fusion, Genotype, Hccv, Matrix, Reannotation

Query = Callable[[SparkSession, str], DataFrame]
COUNTING = Counting(min_bq=5, min_mq=60)
CALLING = Calling(min_cov=8)
FINAL = Final(clust_dist=400)
HCCV = Hccv(min_dp=8, clust_dist=400)
FUSION = Fusion(max_mcf_noncancer=0.7, delta_mcf=0.1)
REANNOTATION = Reannotation(min_variants=2, min_fraction=0.3)
MATRIX = Matrix(min_cells_per_mut=4, min_pos_cov=2)
REGISTRY: dict[str, Query] = {}
def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def counts(spark, sf):
    return pileup.count_bases(adapter.read_bases(spark, sf), COUNTING)


def called(spark, sf):
    return calling.call_cell_types(counts(spark, sf), CALLING)


def sites(spark, sf):
    return calling.call_sites(counts(spark, sf), adapter.contexts(spark, sf), CALLING)


def annotated(spark, sf):
    black = lambda k: adapter.sites_where(spark, sf, f"p_size % 20 = {k}")
    return calling.annotate_filters(sites(spark, sf), black(1), black(2), black(3), adapter.population_af(spark, sf), Annotation(min_distance=10))


def final(spark, sf):
    return calling.finalize_calls(annotated(spark, sf), FINAL)


def tag_text(column):
    return F.array_join(column, ",")


@query
def cell_type_binarize(spark, sf):
    meta = adapter.table(spark, sf, "customer").select(F.col("c_name").alias("Index"), F.col("c_mktsegment").alias("Cell_type"))
    return reads.binarize_cell_types(meta, "BUILDING")


@query
def clean_metadata(spark, sf):
    meta = adapter.table(spark, sf, "part").select(F.concat(F.col("p_brand"), F.lit("-"), F.col("p_partkey").cast("string")).alias("Index"), F.col("p_type").alias("Cell_type"))
    return reads.clean_metadata(meta, "tissue")


@query
def read_admission_report(spark, sf):
    meta = adapter.barcodes(spark, sf).where("cast(substring(cb, 3) as int) % 13 <> 0")
    return reads.admission_report(reads.admit_reads(adapter.reads(spark, sf), meta, max_nm=5, max_nh=2, min_mq=40))


@query
def read_keys(spark, sf):
    r = adapter.reads(spark, sf)
    return r.select("name", reads.read_key(F.col("cb"), F.lit(None).cast("string"), F.col("name")).alias("key"))


@query
def qual_trim(spark, sf):
    o = adapter.table(spark, sf, "orders").select("o_orderkey", F.transform(F.sequence(F.lit(1), F.lit(45)), lambda i: ((F.col("o_orderkey") + i) % 40 + 1).cast("int")).alias("q"), (F.col("o_orderkey") % 35).cast("int").alias("l"), (F.col("o_custkey") % 35).cast("int").alias("r"))
    trimmed = alleles.clip_trim(F.col("q"), 2, F.col("l"), F.col("r"))
    return o.select("o_orderkey", F.array_join(F.transform(trimmed, lambda x: x.cast("string")), ",").alias("trimmed"))


@query
def reverse_complements(spark, sf):
    return adapter.contexts(spark, sf).select("chrom", "pos", alleles.reverse_complement(F.col("up")).alias("rc"))


@query
def token_classes(spark, sf):
    return adapter.read_bases(spark, sf).groupBy("raw_base", alleles.token_class(F.col("raw_base")).alias("allele")).agg(F.count("*").alias("n"))


@query
def pileup_counts(spark, sf):
    return pileup.flat(counts(spark, sf), ("bc", "bq", "bcf", "bcr")).drop("nc")


@query
def alignment_tokens(spark, sf):
    return read_blocks.count_tokens(adapter.alignments(spark, sf), adapter.CHUNK)


@query
def alignment_pileup(spark, sf):
    counted = read_blocks.count_pileup(adapter.alignments(spark, sf), adapter.CHUNK, adapter.reference_chunks(spark, sf), COUNTING)
    return pileup.flat(counted).select("chrom", "pos", "ref", "cell_type", "dp", "nc", *[f"{k}_{x.lower()}" for k in pileup.KINDS for x in alleles.ALLELES])


@query
def pileup_by_sample(spark, sf):
    by_sample = pileup.count_bases(adapter.read_bases(spark, sf), Counting(min_bq=5, min_dp=2, min_cc=1), keys=("sample_id",))
    return pileup.flat(by_sample, ("cc", "bc", "bq", "bcf", "bcr"))


@query
def pileup_regions(spark, sf):
    """Counts inside the genes' intervals and outside the first 100 bases of each chromosome's thousand."""
    tenth = adapter.sites_where(spark, sf, "true").select("chrom", (F.floor(F.col("pos") / 1000) * 1000).alias("start")).distinct()
    counted = pileup.count_bases(adapter.read_bases(spark, sf), COUNTING, regions=genes(spark, sf).withColumn("end", F.col("start") + 200), excluded=tenth.withColumn("end", F.col("start") + 100))
    return pileup.flat(counted, ("bc",)).drop("nc")


@query
def distinct_cells_per_base(spark, sf):
    return pileup.flat(counts(spark, sf).drop("bc", "bq", "bcf", "bcr"), ("cc",)).drop("dp")


@query
def frequent_alternative(spark, sf):
    return pileup.frequent_alternative(counts(spark, sf)).select("chrom", "pos", "cell_type", "top_alt")


@query
def merge_cell_types(spark, sf):
    return pileup.to_wide(counts(spark, sf), ["Cancer", "Non-Cancer"]).select("chrom", "pos", F.col("Cancer").alias("dp_cancer"), F.col("Non-Cancer").alias("dp_noncancer"))


@query
def ref_conflict(spark, sf):
    part = adapter.read_bases(spark, sf).select("chrom", "pos", "cb", F.when(F.col("base_qual") % 5 == 0, "N").otherwise(F.col("ref")).alias("ref"))
    return pileup.reference_of(part)


@query
def betabinom_pvalues(spark, sf):
    out = called(spark, sf).select("chrom", "pos", "cell_type", F.explode("alts").alias("a"))
    return out.select("chrom", "pos", "cell_type", "a.alt", "a.bc", "a.cc", "a.vaf", "a.mcf", "a.p_bc", "a.p_cc")


@query
def celltype_filter(spark, sf):
    return called(spark, sf).where("filter IS NOT NULL").select("chrom", "pos", "ref", "cell_type", "dp", "nc", F.array_join(F.transform("alts", lambda a: a["alt"]), "|").alias("alts"), "filter")


@query
def site_rollup(spark, sf):
    return calling.site_rollup(called(spark, sf)).select("chrom", "pos", "ref", "n_callable", "rest_bc", "rest_cc", "rest_dp", "rest_nc", F.size("calls").cast("long").alias("n_calls"))


@query
def site_filter(spark, sf):
    s = sites(spark, sf).where("size(calls) > 0")
    return s.select("chrom", "pos", "ref", F.col("n_alts").cast("long").alias("n_alts"), alleles.shown(F.col("filters")).alias("filter"))


@query
def nonvariant_noise(spark, sf):
    # Bases other than insertions and deletions are left out here, so that sites without a candidate exist.
    rb = adapter.read_bases(spark, sf).where("length(raw_base) > 1 OR upper(raw_base) = ref")
    s = calling.call_sites(pileup.count_bases(rb, COUNTING), None, CALLING).where("size(calls) = 0")
    return s.select("chrom", "pos", "rest_bc", "rest_dp", "p_noise_bc", "p_noise_cc", alleles.shown(F.col("filters")).alias("filter"))


@query
def homopolymer_context(spark, sf):
    s = adapter.sites_where(spark, sf, "p_partkey > 0")
    out = calling.reference_context(s, adapter.reference_chunks(spark, sf), adapter.CHUNK)
    return out.select("chrom", "pos", "up", "down", alleles.long_run(F.concat("up", F.lit("A"))).alias("lc_up"), alleles.long_run(F.concat(F.lit("T"), "down")).alias("lc_down"))


@query
def coverage_histogram(spark, sf):
    return calling.coverage_histogram(counts(spark, sf), CALLING)


@query
def blacklist_flags(spark, sf):
    s = adapter.sites_where(spark, sf, "true")
    for k, name in ((1, "edited"), (2, "in_sr"), (3, "in_lr")):
        s = calling.flagged(s, adapter.sites_where(spark, sf, f"p_size % 20 = {k}"), name)
    return s


@query
def neighbour_clustered(spark, sf):
    s = adapter.sites_where(spark, sf, "true")
    return calling.near_in_order(s, "clustered", 10)


@query
def population_af(spark, sf):
    a = annotated(spark, sf)
    return a.select("chrom", "pos", "alt", "af", F.array_contains("filters", "gnomAD").alias("common"))


@query
def annotated_filters(spark, sf):
    return annotated(spark, sf).select("chrom", "pos", tag_text(F.col("filters")).alias("filter"))


@query
def multiallelic_major(spark, sf):
    m = calling.major_allele(annotated(spark, sf))
    return m.select("chrom", "pos", "alt", "multi", F.col("cancer.bc").alias("bc_cancer"), F.col("cancer.cc").alias("cc_cancer"), F.col("cancer.vaf").alias("vaf_cancer"), F.col("noncancer.bc").alias("bc_noncancer"), F.col("noncancer.vaf").alias("vaf_noncancer"), F.col("noncancer.mcf").alias("mcf_noncancer"))


@query
def chrm_branch(spark, sf):
    m = calling.major_allele(annotated(spark, sf)).where("chrom = 'chrM'")
    m = m.where(~alleles.any_tag(F.col("filters"), alleles.CHRM_DROPS))
    return m.select("chrom", "pos", "alt", F.coalesce(calling.chrm_tag(FINAL), F.lit("PASS")).alias("tag"))


@query
def cancer_support(spark, sf):
    m = calling.major_allele(annotated(spark, sf))
    return m.select("chrom", "pos", "alt", F.coalesce(calling.support_tag(FINAL), F.lit("PASS")).alias("tag"))


@query
def betabin_consistency(spark, sf):
    m = calling.major_allele(annotated(spark, sf))
    return m.select("chrom", "pos", "alt", F.coalesce(calling.consistency_tag(), F.lit("PASS")).alias("tag"))


@query
def clustered_snvs(spark, sf):
    s = adapter.sites_where(spark, sf, "true").withColumn("alt", F.lit("A"))
    return calling.close_pairs(calling.close_pairs(s, "close", 400), "close_text", 400, strict_compat=True).select("chrom", "pos", "close", "close_text")


@query
def final_unfiltered(spark, sf):
    return final(spark, sf).select("key", tag_text(F.col("final")).alias("final"))


@query
def final_pass(spark, sf):
    return calling.passing(final(spark, sf)).select("chrom", "pos", "ref", "alt", "key", F.col("cancer.vaf").alias("vaf"), F.col("cancer.mcf").alias("mcf"))


@query
def hccv_depth(spark, sf):
    m = calling.major_allele(annotated(spark, sf))
    return m.select("chrom", "pos", hccv.depth_tag(12).alias("tag"))


@query
def hccv_candidates(spark, sf):
    return hccv.hccv_candidates(annotated(spark, sf), HCCV).select("key", "hccv")


@query
def hccv_select(spark, sf):
    return hccv.select_hccv(annotated(spark, sf), HCCV).select("key", F.col("cancer.vaf").alias("vaf"))


@query
def fusion_explode(spark, sf):
    return fusion.explode_accessions(adapter.fusion_predictions(spark, sf)).select("fusion", "bc", "umi", "read_name")


@query
def fusion_rename(spark, sf):
    return fusion.rename_duplicates(adapter.fusion_predictions(spark, sf)).select("fusion", "ordinal")


@query
def fusion_filter(spark, sf):
    allf, _, _ = fusion.filter_fusions(adapter.fusion_predictions(spark, sf), adapter.fusion_barcodes(spark, sf), FUSION)
    return allf.select("fusion", "umi_cancer", "umi_noncancer", "bc_cancer", "bc_noncancer", F.round("mcf_cancer", 6).alias("mcf_cancer"), F.round("mcf_noncancer", 6).alias("mcf_noncancer"), "decision")


def variants(spark, sf):
    return adapter.sites_where(spark, sf, "true").join(
        adapter.table(spark, sf, "part").select(adapter.chrom("p_partkey").alias("chrom"), adapter.pos("p_partkey").alias("pos"), adapter.letter("ACTG", F.col("p_partkey") % 4).alias("ref"), adapter.letter("CTGA", F.col("p_partkey") % 4).alias("alt")), ["chrom", "pos"]
    )


def genotypes(spark, sf, dense=True):
    return genotype.genotype_cells(variants(spark, sf), adapter.read_bases(spark, sf), adapter.barcodes(spark, sf), Genotype(min_bq=5, p_value=0.2), dense)


def variant_keys(spark, sf):
    return variants(spark, sf).select(alleles.variant_key(F.col("chrom"), F.col("pos"), F.col("alt")).alias("key")).distinct()


def fusion_cells(spark, sf):
    allf, _, long = fusion.filter_fusions(adapter.fusion_predictions(spark, sf), adapter.fusion_barcodes(spark, sf), FUSION)
    return long.select("fusion", F.col("bc").alias("cb"))


@query
def genotype_grid(spark, sf):
    return genotypes(spark, sf).select("key", "cb", F.col("dp").cast("long").alias("dp"), F.col("n_alt").cast("long").alias("n_alt"), "vaf")


@query
def genotype_status(spark, sf):
    return genotypes(spark, sf).select("key", "cb", "p", "status", F.col("mutated").cast("long").alias("mutated"))


@query
def matrix_pivot(spark, sf):
    return genotype.to_rows(variant_keys(spark, sf), genotypes(spark, sf, dense=False), "mutated", adapter.barcodes(spark, sf).count(), genotype.shares(adapter.read_bases(spark, sf).count()))


@query
def snv_fusion_union(spark, sf):
    return genotype.key_totals(variant_keys(spark, sf), genotypes(spark, sf, dense=False), fusion_cells(spark, sf), adapter.barcodes(spark, sf).count())


@query
def matrix_filter(spark, sf):
    long = genotype.with_fusions(genotypes(spark, sf, dense=False), fusion_cells(spark, sf))
    return genotype.filter_matrix(long, MATRIX, dense=True).select("key", "cb", F.col("mutated").cast("long").alias("mutated"))


@query
def natural_sort(spark, sf):
    return genotype.natural_rank(variant_keys(spark, sf).union(fusion_cells(spark, sf).select("fusion")).distinct())


@query
def reannotate_cells(spark, sf):
    return hccv.reannotate(genotypes(spark, sf, dense=False), fusion_cells(spark, sf), adapter.barcodes(spark, sf), REANNOTATION).select("cb", "before", "cell_type", "n_covered", "n_mutated", "n_fusions")


@query
def panel_of_normals(spark, sf):
    by_sample = pileup.count_bases(adapter.read_bases(spark, sf), Counting(min_bq=5, min_dp=2, min_cc=1), keys=("sample_id",))
    called_ = calling.call_cell_types(by_sample, Calling(min_cov=2, min_cells=1)).groupBy("sample_id", "chrom", "pos").agg(F.count("filter").alias("n")).where("n > 0")
    return cohort.panel_of_normals(called_.withColumn("filters", F.array(F.lit("x"))), 2, strip_chr=True)


@query
def betabin_training(spark, sf):
    return cohort.training_counts(counts(spark, sf))


@query
def betabin_histogram(spark, sf):
    t = cohort.training_counts(counts(spark, sf))
    return t.groupBy("alt_reads", "dp").agg(F.count("*").alias("n"))


@query
def betabin_fit(spark, sf):
    fit = cohort.fit_beta_binomial(cohort.training_counts(counts(spark, sf)))
    return spark.createDataFrame([tuple(fit.values())], ", ".join(f"{k} double" for k in fit))


@query
def per_file_sample(spark, sf):
    return cohort.sample_per_file(adapter.read_bases(spark, sf).select("sample_id", "chrom", "pos", "cb"), "sample_id", 50)


@query
def fisher_strand(spark, sf):
    t = counts(spark, sf).select("bcf", "bcr", "ref").select(*[alleles.at(F.col(k), F.lit(x)).alias(f"{k}_{x}") for k in ("bcf", "bcr") for x in ("A", "C")]).distinct()
    return t.select("bcf_A", "bcr_A", "bcf_C", "bcr_C", betabinom.fisher(F.col("bcf_A"), F.col("bcr_A"), F.col("bcf_C"), F.col("bcr_C")).alias("p"))


@query
def range_neighbours(spark, sf):
    return intervals.neighbours(adapter.sites_where(spark, sf, "true"), adapter.sites_where(spark, sf, "true"), 600)


def genes(spark, sf):
    return adapter.intervals(spark, sf, "p_size * 37")


def regions(spark, sf):
    return adapter.intervals(spark, sf, "p_size * 11")


@query
def interval_merge(spark, sf):
    return intervals.merge(genes(spark, sf), 1)


@query
def interval_overlaps(spark, sf):
    return intervals.overlaps(genes(spark, sf), regions(spark, sf), 1000)


@query
def interval_overlap_count(spark, sf):
    return intervals.overlap_counts(genes(spark, sf), regions(spark, sf), 1000)


@query
def interval_subtract(spark, sf):
    return intervals.subtract(genes(spark, sf), regions(spark, sf), 1000)


@query
def tile_windows(spark, sf):
    return intervals.tile(genes(spark, sf), 500)


@query
def gene_counts(spark, sf):
    li = adapter.table(spark, sf, "lineitem")
    c = li.select(F.concat(F.lit("ENSG"), F.col("l_partkey").cast("string")).alias("ensg"), F.concat(F.lit("CB"), F.col("l_suppkey").cast("string")).alias("cb"), F.col("l_quantity").cast("long").alias("n"))
    g = adapter.table(spark, sf, "part").where("p_partkey % 4 <> 0").select(F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string")).alias("ensg"), F.col("p_brand").alias("gene"))
    return cohort.gene_counts(c, g)


def clusterings(spark, sf):
    return adapter.table(spark, sf, "embeddings").select(F.col("vec_id").alias("cell"), (F.col("label") + F.when(F.col("vec_id") % 5 == 0, 1).otherwise(0)).cast("long").alias("pred"), F.col("label").cast("long").alias("true"))


@query
def ari(spark, sf):
    return metrics.adjusted_rand(clusterings(spark, sf))


@query
def v_measure(spark, sf):
    return metrics.v_measure(clusterings(spark, sf))


def genotype_guess(spark, sf):
    m = adapter.cell_matrix(spark, sf)
    return m.select("cell", "mut", F.when((F.col("cell") * 3 + F.col("mut")) % 10 == 0, 1 - F.col("value")).otherwise(F.col("value")).alias("value"))


@query
def hamming(spark, sf):
    return metrics.hamming(genotype_guess(spark, sf), adapter.cell_matrix(spark, sf))


@query
def fn_fp_empirical(spark, sf):
    return metrics.error_rates(genotype_guess(spark, sf), adapter.cell_matrix(spark, sf))


def samples(spark, sf):
    cells = adapter.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("cell"))
    return cells.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("sample")).withColumn("cluster", F.floor((F.col("cell") + F.col("sample") % 3) / 10) % 5)


@query
def coclustering_similarity(spark, sf):
    return metrics.coclustering(samples(spark, sf))


@query
def mpear_score(spark, sf):
    s = samples(spark, sf)
    return metrics.mpear(s, s.where("sample = 0").select("cell", "cluster"))


@query
def ward_clusters(spark, sf):
    return linkage.best_cut(samples(spark, sf))


@query
def posterior_genotypes(spark, sf):
    s = samples(spark, sf)
    split = F.when((F.col("cluster") != 0) & (F.col("cell") % 7 == 0), 5).otherwise(F.col("cluster"))
    assigned = s.where("sample = 1").select("cell", split.alias("cluster"))
    found = clustering.averaged_genotypes(s, clustering.trace_profiles(adapter.cell_matrix(spark, sf), s), assigned)
    return found.select("cluster", "mut", F.round("theta", 6).alias("theta"), "called")


def trace(spark, sf):
    t = adapter.pseudo_trace(spark, sf)
    return t.withColumn("step", (F.row_number().over(Window.partitionBy("chain").orderBy("event_id")) - 1).cast("long")).drop("event_id")


@query
def lugsail_psrf(spark, sf):
    return metrics.lugsail_psrf(trace(spark, sf).withColumnRenamed("ll", "value"))


@query
def ml_map_estimate(spark, sf):
    return metrics.best_steps(trace(spark, sf))


@query
def latent_summary(spark, sf):
    s = metrics.latent_summary(trace(spark, sf), "ll", "lpost")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


@query
def cluster_order(spark, sf):
    return metrics.cluster_order(clusterings(spark, sf).select("cell", F.col("pred").alias("cluster")))


def tree(spark, sf):
    """Every part but the first hangs on the one before it, or, each third one, on the part of half its number."""
    k = F.col("p_partkey")
    part = adapter.table(spark, sf, "part").where("p_partkey > 1")
    return part.select(F.when(k % 3 == 0, F.floor(k / 2)).otherwise(k - 1).alias("parent"), k.alias("child"), F.col("p_size").cast("long").alias("length"))


@query
def tree_collapse(spark, sf):
    return trees.collapse_unary(tree(spark, sf))


@query
def tree_placement(spark, sf):
    members = adapter.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("set"), F.col("l_partkey").alias("node"))
    return trees.place_sets(tree(spark, sf), members)


def chains(spark, sf):
    return posterior.sample_posterior(adapter.cell_matrix(spark, sf).select("cell", "mut", "value"), Clustering())


@query
def mcmc_chains(spark, sf):
    return posterior.chain_scores(chains(spark, sf))


@query
def posterior_clusters(spark, sf):
    return clustering.consensus(chains(spark, sf))
