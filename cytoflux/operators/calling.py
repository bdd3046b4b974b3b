"""Site calling: alleles and p-values per cell type, site filters, annotation, final calls.

Everything between the counts and the site table is an expression per (site, cell type); one aggregation by site
follows. Calls carry `calls`, an array of structs sorted by cell type, instead of packed strings, so that no step
depends on the order in which cell types were listed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.functions.alleles import BASES, CHRM_DROPS, FINAL_DROPS, any_tag, at, fraction, long_run, tags, variant_key, without_tag
from cytoflux.functions.betabinom import fisher, tail
from cytoflux.operators.pileup import SITE
from cytoflux.plans.params import Annotation, Calling, Final

COVERAGE_STEPS = (5, 10, 20, 30)
#: Positions whose neighbours are sought in one window.
NEAR_BIN = 100_000


def _sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0).cast("long"), lambda s, x: s + x)


def call_cell_types(counts: DataFrame, params: Calling | None = None) -> DataFrame:
    """counts plus callable, alts (array of structs, by allele), filter and the sums that the site needs.

    A candidate is any base other than the reference with a read; filter is null without one, or if not callable.
    """
    params = params or Calling()
    callable_ = (F.col("dp") >= params.min_cov) & (F.col("nc") >= params.min_cells)
    of = lambda x: F.struct(F.lit(x).alias("alt"), *[at(F.col(k), F.lit(x)).alias(k) for k in ("bc", "cc", "bcf", "bcr")])
    candidates = F.filter(F.array(*map(of, sorted(BASES))), lambda c: F.col("callable") & (c["alt"] != F.col("ref")) & (c["bc"] > 0))

    def tested(c: Column) -> Column:
        strand = [fisher(c["bcf"], c["bcr"], at(F.col("bcf"), F.col("ref")), at(F.col("bcr"), F.col("ref"))).alias("p_strand")] if params.fisher_cutoff != 1 else []
        return F.struct(
            c["alt"].alias("alt"), c["bc"].alias("bc"), c["cc"].alias("cc"), fraction(c["bc"], F.col("dp")).alias("vaf"), fraction(c["cc"], F.col("nc")).alias("mcf"),
            tail(c["bc"], F.col("dp"), *params.reads_ab).alias("p_bc"), tail(c["cc"], F.col("nc"), *params.cells_ab).alias("p_cc"), *strand,
        )

    # Written once for all bases, and generated, so that Spark doesn't copy the tests into whatever looks at a candidate.
    out = counts.withColumn("callable", callable_).withColumn("alts", F.explode(F.array(F.transform(candidates, tested))))
    low = lambda name: F.array_min(F.transform("alts", lambda a: a[name]))
    p, q, first = low("p_bc"), low("p_cc"), F.get("alts", 0)
    cascade = (
        F.when(F.size("alts") == 0, F.lit(None)).when((p >= 0.05) | (q >= 0.05), "Non-Significant")
        .when(((p > 0.001) & (p < 0.05)) | ((q > 0.001) & (q < 0.05)), "Low-Significance")
        .when(F.size("alts") > 1, "Multi-allelic").when(first["cc"] < params.min_ac_cells, "Low_cells").when(first["bc"] < params.min_ac_reads, "Low_reads")
    )
    if params.fisher_cutoff != 1:
        cascade = cascade.when(first["p_strand"] < params.fisher_cutoff, "Fisher")
    out = out.withColumn("filter", cascade.otherwise("PASS"))
    others = lambda kind: F.when(F.col("callable"), _sum(F.col(kind)) - at(F.col(kind), F.col("ref"))).otherwise(0)
    candidates = lambda name: _sum(F.transform("alts", lambda a: a[name]))
    return out.withColumns({
        "rest_bc": others("bc") - candidates("bc"), "rest_cc": others("cc") - candidates("cc"),
        "rest_dp": F.when(F.col("callable"), F.col("dp")).otherwise(0) - candidates("bc"), "rest_nc": F.when(F.col("callable"), F.col("nc")).otherwise(0) - candidates("cc"),
    })


def site_rollup(called: DataFrame) -> DataFrame:
    """One row a site: calls, number of callable cell types and the counts that no candidate explains."""
    call = F.when(F.size("alts") > 0, F.struct("cell_type", "dp", "nc", "alts", "filter"))
    info = F.struct("cell_type", "dp", "nc", "bc", "cc")
    sums = [F.sum(c).alias(c) for c in ("rest_bc", "rest_cc", "rest_dp", "rest_nc")]
    return called.groupBy(*SITE).agg(F.count_if("callable").alias("n_callable"), *sums, F.sort_array(F.collect_list(call)).alias("calls"), F.sort_array(F.collect_list(info)).alias("counts"))


def noise(sites: DataFrame, params: Calling) -> DataFrame:
    """sites plus p_noise_bc and p_noise_cc: 1 where nothing is left to explain."""
    some = F.col("rest_bc") > 0
    p = lambda k, n, ab: F.when(some, tail(F.col(k), F.col(n), *ab)).otherwise(1.0)
    return sites.withColumns({"p_noise_bc": p("rest_bc", "rest_dp", params.reads_ab), "p_noise_cc": p("rest_cc", "rest_nc", params.cells_ab)})


def call_sites(counts: DataFrame, context: DataFrame | None = None, params: Calling | None = None) -> DataFrame:
    """Step 1: one row a site with calls, filters (array; empty: pass; null: no candidate and no noise) and n_alts.

    context: chrom, pos, up, down. A candidate site without tags but without a passing cell type has the filters of
    its cell types as tags.
    """
    params = params or Calling()
    sites = noise(site_rollup(call_cell_types(counts, params)), params)
    if context is not None:
        sites = sites.join(context.select("chrom", "pos", "up", "down"), ["chrom", "pos"], "left")
    else:
        sites = sites.withColumns({"up": F.lit("."), "down": F.lit(".")})
    of = F.transform("calls", lambda c: c["filter"])
    names = F.transform("calls", lambda c: F.array_join(F.transform(c["alts"], lambda a: a["alt"]), "|"))
    n = lambda *kinds: F.size(F.filter(of, lambda f: f.isin(*kinds)))
    runs = lambda side: F.exists(names, lambda a: long_run(F.concat(F.col("up"), a) if side == "up" else F.concat(a, F.col("down"))))
    tagged = tags(
        (n("PASS") > params.max_cell_types, "Multiple_cell_types"), ((F.size(F.array_distinct(names)) > 1) | (n("Multi-allelic") > 0), "Multi-allelic"),
        (F.col("n_callable") < params.min_cell_types, "Min_cell_types"), (F.size("calls") > n("PASS", "Non-Significant"), "Cell_type_noise"),
        ((F.col("p_noise_bc") < 0.05) | (F.col("p_noise_cc") < 0.05), "Noisy_site"), (runs("up"), "LC_Upstream"), (runs("down"), "LC_Downstream"),
    )
    quiet = F.when((F.col("p_noise_bc") < 0.001) | (F.col("p_noise_cc") < 0.001), F.array(F.lit("Noisy_site")))
    candidate = F.size("calls") > 0
    sites = sites.withColumns({"n_alts": F.size(F.array_distinct(names)), "tagged": tagged})
    filters = F.when(~candidate, quiet).when(F.size("tagged") > 0, F.col("tagged")).when(n("PASS") > 0, F.array().cast("array<string>")).otherwise(of)
    return sites.withColumn("filters", filters).drop("tagged")


def reference_context(sites: DataFrame, chunks: DataFrame, size: int, flank: int = 5) -> DataFrame:
    """sites plus up and down: the `flank` bases on both sides, `.` where the reference has none.

    chunks: chrom, chunk, seq: bases chunk * size + 1 to (chunk + 1) * size, with `flank` more at either end (the
    first chunk has none in front).
    """
    before = F.when(F.col("chunk") > 0, flank).otherwise(0)
    offset = F.col("pos") - F.col("chunk") * size + before
    joined = sites.withColumn("chunk", F.floor((F.col("pos") - 1) / size)).join(chunks, ["chrom", "chunk"], "left")
    first = F.greatest(offset - flank, F.lit(1))
    up, down = F.substring(F.col("seq"), first.cast("int"), (offset - first).cast("int")), F.substring(F.col("seq"), (offset + 1).cast("int"), F.lit(flank))
    return joined.withColumns({"up": F.coalesce(up, F.lit(".")), "down": F.coalesce(down, F.lit("."))}).drop("chunk", "seq")


def coverage_histogram(counts: DataFrame, params: Calling | None = None) -> DataFrame:
    """Per chromosome and cell type how many sites reach each depth and cell count, of sites with enough callable cell types."""
    params = params or Calling()
    steps = sorted({params.min_cov, params.min_cells, *COVERAGE_STEPS})
    called = counts.withColumn("n_callable", F.count_if((F.col("dp") >= params.min_cov) & (F.col("nc") >= params.min_cells)).over(Window.partitionBy(*SITE)))
    covered = called.where(F.col("n_callable") >= params.min_cell_types)
    return covered.groupBy("chrom", "cell_type").agg(*[F.count_if(F.col(c) >= t).alias(f"{c}_{t}") for c in ("dp", "nc") for t in steps])


def with_neighbours(df: DataFrame, name: str, near: Callable[[Column], Column], reach: int, by: Sequence[Column] = (), order: Sequence[str] = ()) -> DataFrame:
    """df plus the flag `name`: whether near(gap) holds for the row before or behind, by pos, of the same chromosome and `by`.

    reach: no gap above it is near. Rows are dealt by bins of positions, so that a chromosome is never one task; rows that
    are within reach of a bin's edge are in the bin beside too, as neighbours only.
    """
    width = max(NEAR_BIN, reach + 1)
    pos, at = F.col("pos"), F.floor(F.col("pos") / width)
    into = lambda bin, own: F.struct(bin.alias("bin"), F.lit(own).alias("own"))
    places = F.array(into(at, True), F.when(pos - at * width <= reach, into(at - 1, False)), F.when((at + 1) * width - pos <= reach, into(at + 1, False)))
    dealt = df.withColumn("near_place", F.explode(F.array_compact(places)))
    window = Window.partitionBy("chrom", "near_place.bin", *by).orderBy("pos", *order)
    gaps = [F.abs(pos - f("pos").over(window)) for f in (F.lag, F.lead)]
    either = F.coalesce(near(gaps[0]), F.lit(False)) | F.coalesce(near(gaps[1]), F.lit(False))
    return dealt.withColumn(name, either).where("near_place.own").drop("near_place")


def near_in_order(df: DataFrame, name: str, distance: int) -> DataFrame:
    """df plus the flag `name`: the site before or behind, of the same chromosome, is at most `distance` away, but not the same place."""
    return with_neighbours(df, name, lambda gap: (gap > 0) & (gap <= distance), distance)


def flagged(df: DataFrame, sites: DataFrame, name: str) -> DataFrame:
    """df plus the flag `name`: whether its place is in sites (chrom, pos)."""
    marks = sites.select("chrom", "pos").distinct().withColumn(name, F.lit(True))
    return df.join(marks, ["chrom", "pos"], "left").withColumn(name, F.coalesce(name, F.lit(False)))


def annotate_filters(calls: DataFrame, editing: DataFrame, pon_sr: DataFrame, pon_lr: DataFrame, af: DataFrame, params: Annotation | None = None) -> DataFrame:
    """Step 2: candidates with the tags of editing sites, neighbours, panels of normals and the population frequency.

    af: chrom, pos, ref, alt, af. The frequency is that of the first alternative allele; unknown is 0.
    """
    params = params or Annotation()
    out = calls.where((F.size("calls") > 0) & F.col("filters").isNotNull())
    out = near_in_order(out, "clustered", params.min_distance) if params.min_distance > 0 else out.withColumn("clustered", F.lit(False))
    for sites, name in ((editing, "edited"), (pon_sr, "in_sr"), (pon_lr, "in_lr")):
        out = flagged(out, sites, name)
    out = out.withColumn("alt", first_alt(F.col("calls"))).join(af.select(*SITE, "alt", "af"), [*SITE, "alt"], "left").withColumn("af", F.coalesce("af", F.lit(0.0)))
    more = tags((F.col("edited"), "RNA_editing_db"), (F.col("clustered"), "Clustered"), (F.col("in_sr"), "PoN_SR"), (F.col("in_lr"), "PoN_LR"), (F.col("af") >= params.max_af, "gnomAD"))
    return out.withColumn("filters", F.concat("filters", more)).drop("clustered", "edited", "in_sr", "in_lr")


def first_alt(calls: Column) -> Column:
    return F.get(calls, 0)["alts"][0]["alt"]


def _of(array: Column, cell_type: str) -> Column:
    return F.get(F.filter(array, lambda c: c["cell_type"] == cell_type), 0)


def major_allele(calls: DataFrame) -> DataFrame:
    """Calls in cancer with one allele each: cancer, noncancer (structs of alt, bc, cc, vaf, mcf, dp, nc, filter), multi and filters.

    Where several alleles compete, the one with most cancer reads (first of A, C, T, G among equals) is taken for
    both cell types; multi says that the next one has 5 % or more of its reads.
    """
    df = calls.withColumns({"ca": _of(F.col("calls"), "Cancer"), "no": _of(F.col("calls"), "Non-Cancer"), "ca_counts": _of(F.col("counts"), "Cancer"), "no_counts": _of(F.col("counts"), "Non-Cancer")})
    df = df.where(F.col("ca").isNotNull())
    several = F.array_contains("filters", "Multi-allelic") | (F.size(F.col("ca.alts")) > 1) | (F.coalesce(F.size(F.col("no.alts")), F.lit(0)) > 1)
    reads = F.array(*[F.when(F.col("ref") == x, 0).otherwise(F.col("ca_counts.bc")[i]) for i, x in enumerate(BASES)])
    df = df.withColumns({"several": several, "reads": reads})
    best = F.element_at(F.array(*map(F.lit, BASES)), F.array_position("reads", F.array_max("reads")).cast("int"))
    second = F.element_at(F.sort_array("reads", asc=False), 2)
    df = df.withColumn("best", F.when(F.col("several"), best).otherwise(F.col("ca.alts")[0]["alt"]))

    def one(call: str, counts: str) -> Column:
        bc, cc = at(F.col(f"{counts}.bc"), F.col("best")), at(F.col(f"{counts}.cc"), F.col("best"))
        own = F.col(f"{call}.alts")[0]
        pick = lambda new, old: F.when(F.col("several"), new).otherwise(old)
        return F.when(F.col(call).isNotNull(), F.struct(
            pick(F.col("best"), own["alt"]).alias("alt"), pick(bc, own["bc"]).alias("bc"), pick(cc, own["cc"]).alias("cc"), pick(fraction(bc, F.col(f"{call}.dp")), own["vaf"]).alias("vaf"),
            pick(fraction(cc, F.col(f"{call}.nc")), own["mcf"]).alias("mcf"), F.col(f"{call}.dp").alias("dp"), F.col(f"{call}.nc").alias("nc"), F.col(f"{call}.filter").alias("filter"),
        ))

    multi = F.col("several") & ~F.coalesce(second / F.nullif(F.array_max("reads"), F.lit(0)) < 0.05, F.lit(True))
    alone = F.col("several") & F.col("no").isNull()
    return df.withColumns({"cancer": one("ca", "ca_counts"), "noncancer": one("no", "no_counts"), "multi": multi, "alt": F.col("best"), "filters": F.when(alone, without_tag(F.col("filters"), "Multi-allelic")).otherwise(F.col("filters"))}).drop("ca", "no", "several", "reads", "best")


def chrm_tag(params: Final) -> Column:
    """Mitochondrial sites: depth, and VAF and MCF against other cells where those were called."""
    ca, no = F.col("cancer"), F.col("noncancer")
    both = F.when((ca["dp"] < 100) | (no["dp"] < 100), "LowDepth").when(ca["vaf"] - no["vaf"] < params.delta_vaf, "LowDeltaVAF").when(ca["mcf"] - no["mcf"] < params.delta_mcf, "LowDeltaMCF")
    alone = F.when(ca["dp"] < 100, "LowDepth").when(ca["vaf"] < 0.05, "LowVAF").when(ca["mcf"] < 0.05, "LowMCF")
    return F.when(no.isNotNull(), both).otherwise(alone)


def support_tag(params: Final) -> Column:
    bc, cc = at(F.col("ca_counts.bc"), F.col("alt")), at(F.col("ca_counts.cc"), F.col("alt"))
    return F.when(F.col("ca_counts").isNull(), "NoCov").when((bc < params.min_ac_reads) | (cc < params.min_ac_cells), "LowDepth")


def consistency_tag() -> Column:
    return F.when(F.col("cancer.filter").isin("Non-Significant", "Low-Significance"), "CancerNonSig").when(F.col("noncancer.filter").isin("PASS", "Low-Significance"), "NonCancerSig")


def close_pairs(df: DataFrame, name: str, distance: int, strict_compat: bool = False, among: Column | None = None) -> DataFrame:
    """df plus the flag `name`: a neighbour in order is less than `distance` away; chrM is exempt.

    among: only rows that agree in it are neighbours. strict_compat orders positions as text, which has no bins: there a
    chromosome is one task.
    """
    by = [] if among is None else [among]
    if strict_compat:
        window = Window.partitionBy("chrom", *by).orderBy(F.col("pos").cast("string"), "alt")
        gaps = [F.coalesce(F.abs(F.col("pos") - f("pos").over(window)) < distance, F.lit(False)) for f in (F.lag, F.lead)]
        out = df.withColumn(name, gaps[0] | gaps[1])
    else:
        out = with_neighbours(df, name, lambda gap: gap < distance, distance, by, ["alt"])
    return out.withColumn(name, F.col(name) & (F.col("chrom") != "chrM"))


def finalize_calls(calls: DataFrame, params: Final | None = None) -> DataFrame:
    """Step 3: calls in cancer with final tags (`final`, empty: pass). The passing ones are the calls, all are the unfiltered table.

    One pass: mitochondrial and other sites differ in expressions, and neighbours are sought among clean rows by a window.
    """
    params = params or Final()
    df = major_allele(calls)
    is_m = (F.col("chrom") == "chrM") if params.chrm_contaminant else F.lit(False)
    first = F.when(F.col("multi"), "Multi-Allelic")
    df = df.where(~F.when(is_m, any_tag(F.col("filters"), CHRM_DROPS)).otherwise(any_tag(F.col("filters"), FINAL_DROPS)))
    own = F.array_compact(F.array(first, F.when(is_m, chrm_tag(params)).otherwise(support_tag(params)), F.when(~is_m, consistency_tag())))
    df = df.withColumn("final", own).withColumn("clean", F.size("final") == 0)
    df = close_pairs(df, "close", params.clust_dist, params.strict_compat, F.col("clean"))
    final = F.when(F.col("clean") & F.col("close"), F.array_append("final", F.lit(f"Clust_dist_{params.clust_dist}"))).otherwise(F.col("final"))
    return df.withColumn("final", final).withColumn("key", variant_key(F.col("chrom"), F.col("pos"), F.col("alt"))).drop("close", "clean")


def passing(final: DataFrame) -> DataFrame:
    return final.where(F.size("final") == 0)

