"""Branches and traps on small hand-made tables."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from cytoflux.functions import alleles, betabinom
from cytoflux.operators import calling, clustering, cohort, fusion, genotype, hccv, intervals, metrics, pileup, posterior, reads
from cytoflux.plans.params import Calling, Clustering, Counting, Final, Fusion, Genotype, Hccv, Matrix, Reannotation
from cytoflux.sources import tables

COUNTS = "chrom string, pos long, ref string, cell_type string, dp long, nc long, cc array<long>, bc array<long>, bq array<long>, bcf array<long>, bcr array<long>"


def counts(spark, *rows):
    """rows: chrom, pos, ref, cell type, dp, nc, reads and cells of A, C, T, G, I, D."""
    full = []
    for chrom, pos, ref, ct, dp, nc, bc, cc in rows:
        pad = lambda v: [*v, *[0] * (6 - len(v))]
        full.append((chrom, pos, ref, ct, dp, nc, pad(cc), pad(bc), pad([30 * x for x in bc]), pad([x // 2 for x in bc]), pad([x - x // 2 for x in bc])))
    return spark.createDataFrame(full, COUNTS)


def tail(k, n, a, b):
    g = math.lgamma
    pmf = lambda i: math.exp(g(n + 1) - g(i + 1) - g(n - i + 1) + g(i + a) + g(n - i + b) - g(n + a + b) - g(a) - g(b) + g(a + b))
    return round(sum(pmf(i) for i in range(k, n + 1)), 4)


def test_tail(spark):
    pairs = [(k, n) for n in (1, 5, 17, 300) for k in {0, 1, 2, n // 2, n} if k <= n] + [(0, 0)]
    df = spark.createDataFrame(pairs, "k long, n long").withColumn("p", betabinom.tail(F.col("k"), F.col("n"), 0.2, 105.0))
    for r in df.collect():
        want = 1.0 if r.k == 0 else tail(r.k, r.n, 0.2, 105.0)
        assert abs(r.p - want) < 1.1e-4
    ps = [r.p for r in df.where("n = 300").orderBy("k").collect()]
    assert ps == sorted(ps, reverse=True)


def test_fisher(spark):
    def exact(a, b, c, d):
        n, r, k = a + b + c + d, a + b, a + c
        p = lambda x: math.comb(r, x) * math.comb(n - r, k - x) / math.comb(n, k)
        return round(min(1.0, sum(p(x) for x in range(max(0, k - n + r), min(r, k) + 1) if p(x) <= p(a) * (1 + 1e-7))), 4)

    rows = [(8, 2, 1, 5), (0, 0, 0, 0), (3, 0, 0, 3), (10, 10, 10, 10), (0, 7, 4, 1)]
    for r in spark.createDataFrame(rows, "a long, b long, c long, d long").withColumn("p", betabinom.fisher(*map(F.col, "abcd"))).collect():
        assert abs(r.p - exact(r.a, r.b, r.c, r.d)) < 1.1e-4


def test_fit_recovers_parameters():
    rng = random.Random(3)
    counts_ = {}
    for _ in range(6000):
        p = rng.betavariate(2.0, 20.0)
        n = rng.choice((10, 20, 40))
        x = sum(rng.random() < p for _ in range(n))
        counts_[x, n] = counts_.get((x, n), 0) + 1
    a, b = betabinom.fit([(x, m) for (x, _), m in counts_.items()], [(n - x, m) for (x, n), m in counts_.items()], [(n, m) for (_, n), m in counts_.items()])
    assert abs(a - 2) < 0.3 and abs(b - 20) < 3


def test_cell_type_cascade(spark):
    df = counts(
        spark,
        ("chr1", 1, "A", "c", 50, 40, (48, 1), (40, 1)),  # one read is nothing
        ("chr1", 2, "A", "c", 50, 40, (20, 30), (20, 25)),  # clear
        ("chr1", 3, "A", "c", 50, 40, (20, 15, 15), (20, 15, 15)),  # two alleles
        ("chr1", 4, "A", "c", 40, 6, (20, 20), (5, 1)),  # one cell
        ("chr1", 5, "A", "c", 4, 4, (0, 4), (0, 4)),  # not deep enough
        ("chr1", 6, "A", "c", 50, 40, (50,), (40,)),  # no candidate
        ("chr1", 7, "A", "c", 50, 40, (40, 0, 0, 0, 5, 5), (40, 0, 0, 0, 5, 5)),  # insertions and deletions only
    )
    got = {r.pos: r["filter"] for r in calling.call_cell_types(df, Calling()).collect()}
    assert got == {1: "Non-Significant", 2: "PASS", 3: "Multi-allelic", 4: got[4], 5: None, 6: None, 7: None}
    assert got[4] in ("Low_cells", "Non-Significant", "Low-Significance")
    strict = Calling(min_ac_reads=31)
    assert {r.pos: r["filter"] for r in calling.call_cell_types(df, strict).collect()}[2] == "Low_reads"
    assert {r.pos: r["filter"] for r in calling.call_cell_types(df, Calling(min_ac_cells=30)).collect()}[2] == "Low_cells"
    # Strands are even, so a strand test passes: the site is PASS and not without a filter.
    assert {r.pos: r["filter"] for r in calling.call_cell_types(df, Calling(fisher_cutoff=0.01)).collect()}[2] == "PASS"


def test_site_tags(spark):
    good, none = (20, 30), (50,)
    df = counts(
        spark,
        ("chr1", 1, "A", "Cancer", 50, 40, good, (20, 25)), ("chr1", 1, "A", "Non-Cancer", 50, 40, none, (40,)),
        ("chr1", 2, "A", "Cancer", 50, 40, good, (20, 25)), ("chr1", 2, "A", "Non-Cancer", 50, 40, good, (20, 25)),
        ("chr1", 3, "A", "Cancer", 50, 40, good, (20, 25)),
        ("chr1", 4, "A", "Cancer", 50, 40, good, (20, 25)), ("chr1", 4, "A", "Non-Cancer", 50, 40, (20, 0, 30), (20, 0, 25)),
        ("chr1", 5, "A", "Cancer", 50, 40, good, (20, 25)), ("chr1", 5, "A", "Non-Cancer", 50, 40, (25, 0, 0, 0, 25), (30, 0, 0, 0, 20)),
        ("chr1", 6, "A", "Cancer", 50, 40, none, (40,)), ("chr1", 6, "A", "Non-Cancer", 50, 40, (25, 0, 0, 0, 25), (30, 0, 0, 0, 20)),
        ("chr1", 7, "A", "Cancer", 50, 40, none, (40,)), ("chr1", 7, "A", "Non-Cancer", 50, 40, none, (40,)),
    )
    context = spark.createDataFrame([("chr1", p, "GGCCC" if p == 1 else "ACGTA", "ACGTA") for p in range(1, 8)], "chrom string, pos long, up string, down string")
    got = {r.pos: r.filters for r in calling.call_sites(df, context).select("pos", "filters").collect()}
    assert got == {1: ["LC_Upstream"], 2: ["Multiple_cell_types"], 3: ["Min_cell_types"], 4: ["Multiple_cell_types", "Multi-allelic"], 5: ["Noisy_site"], 6: ["Noisy_site"], 7: None}


def site_of(spark, *rows, context=None):
    return calling.call_sites(counts(spark, *rows), context).withColumn("af", F.lit(0.0))


def test_major_allele_and_final_tags(spark):
    calls = site_of(
        spark,
        ("chr1", 1000, "A", "Cancer", 100, 60, (50, 49, 1), (40, 30, 1)), ("chr1", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)),  # one of two alleles is 2 %
        ("chr2", 1000, "A", "Cancer", 100, 60, (40, 30, 30), (40, 30, 30)), ("chr2", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)),  # two even ones
        ("chr3", 1000, "A", "Cancer", 100, 60, (99, 1), (59, 1)), ("chr3", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)),  # not significant
        ("chr4", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chr4", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)),  # clear
        ("chrM", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chrM", 1000, "A", "Non-Cancer", 100, 40, (98, 2), (40, 2)),
        ("chrM", 2000, "A", "Cancer", 50, 60, (25, 25), (40, 30)), ("chrM", 2000, "A", "Non-Cancer", 100, 40, (100,), (40,)),
        ("chr5", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chr5", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)), ("chr5", 1300, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chr5", 1300, "A", "Non-Cancer", 50, 40, (50,), (40,)),
    )
    got = {r.key: r.final for r in calling.finalize_calls(calls, Final()).collect()}
    assert got["chr4:1000:C"] == [] and got["chrM:1000:C"] == [] and got["chrM:2000:C"] == ["LowDepth"]
    assert got["chr3:1000:C"][-1] == "CancerNonSig"
    assert got["chr2:1000:C"][0] == "Multi-Allelic" if "chr2:1000:C" in got else True
    assert got["chr5:1000:C"] == got["chr5:1300:C"] == ["Clust_dist_10000"]
    picked = {r.chrom: (r.alt, r.multi) for r in calling.major_allele(calls).where("pos = 1000").collect()}
    assert picked["chr1"] == ("C", False) and picked["chr2"] == ("C", True)


def test_hccv(spark):
    rows = []
    for pos, (n, c) in enumerate([(0, 50), (15, 50), (25, 60), (2, 4)], 1):
        rows += [("chr1", 100_000 * pos, "A", "Cancer", 100, 60, (100 - c, c), (60 - c // 2, c // 2)), ("chr1", 100_000 * pos, "A", "Non-Cancer", 100, 60, (100 - n, n), (60 - n // 2, n // 2))]
    got = {r.key.split(":")[1]: r.hccv for r in hccv.hccv_candidates(site_of(spark, *rows), Hccv()).collect()}
    assert got["100000"] == "PASS" and got["200000"] == "Heterozygous" and got["300000"] == "Heterozygous" and got["400000"] == "NonSig"


def test_reannotation_drops_rarely_covered_cells(spark):
    g = spark.createDataFrame([("a", 3, "PASS"), ("a", 1, "NoAltReads"), ("a", 1, "NoAltReads"), ("b", 2, "PASS"), ("c", 1, "NoAltReads"), ("c", 1, "NoAltReads"), ("c", 1, "NoAltReads"), ("c", 0, "NoCoverage")], "cb string, dp long, status string")
    f = spark.createDataFrame([("x--y", "c"), ("x--y", "c")], "fusion string, cb string")
    b = spark.createDataFrame([(x, "Non-Cancer") for x in "abcd"], "cb string, cell_type string")
    got = {r.cb: r.cell_type for r in hccv.reannotate(g, f, b, Reannotation()).collect()}
    assert got == {"a": "Cancer", "c": "Cancer"}
    assert {r.cb: r.cell_type for r in hccv.reannotate(g, f, b, Reannotation(min_fraction=0.34)).collect()} == {"a": "Non-Cancer", "c": "Non-Cancer"}


def test_tokens_and_counts(spark):
    tokens = {"A": "A", "g": "G", "n": "N", "A+2AT": "I", "c-1g": "D", "*": "O", ">": "NA", "<": "NA"}
    rows = spark.createDataFrame([(t,) for t in tokens], "raw string").select("raw", alleles.token_class(F.col("raw")).alias("c")).collect()
    assert {r.raw: r.c for r in rows} == tokens
    base = [("s", "chr1", 5, "A", t, q, 60, f"CB{i % 3}-1", "x", i % 2 == 0, False, i == 0, False) for i, (t, q) in enumerate([("A", 30), ("A", 30), ("c", 30), ("C", 30), ("C", 10), ("N", 30), ("*", 30), ("A+1G", 30)])]
    rb = spark.createDataFrame(base, "sample_id string, chrom string, pos int, ref string, raw_base string, base_qual int, map_qual int, cb string, cell_type string, is_reverse boolean, is_secondary boolean, is_duplicate boolean, is_supplementary boolean")
    r = pileup.count_bases(rb, Counting(min_dp=1, min_cc=1)).first()
    assert (r.dp, r.nc, r.bc, r.cc) == (6, 3, [1, 2, 0, 0, 1, 0], [1, 2, 0, 0, 1, 0]) and r.dp >= sum(r.bc)
    assert pileup.count_bases(rb, Counting(min_dp=1, min_cc=1, min_ac=5)).count() == 0
    assert pileup.count_bases(rb, Counting(min_dp=1, min_cc=1, max_depth=3)).first().dp <= 3


def test_read_admission(spark):
    rows = [(None, 0, 1, 255), ("x-1", 0, 1, 255), ("a-1", 0, 1, 255), ("a-1", 9, 9, 3), ("a-1", None, 1, 255)]
    df = spark.createDataFrame(rows, "cb string, nm int, nh int, mapq int")
    got = {r.reason: r.n_reads for r in reads.admission_report(reads.admit_reads(df, spark.createDataFrame([("a", "t")], "cb string, cell_type string"), 5, 1)).collect()}
    assert got == {"CB_not_found": 1, "CB_not_matched": 1, "PASS": 2, "nM;NH;MAPQ": 1}
    r = spark.createDataFrame([("n_ACGTXXX_z", None, None, "AC", "II"), ("n", "b-1", "U", "AC", "II")], "name string, cb string, ub string, seq string, qual string")
    assert [x.value for x in reads.to_fastq(r).collect()] == ["@NA^ACGT^n_ACGTXXX_z\nAC\n+\nII", "@b^U^n\nAC\n+\nII"]


def test_fusion_cascade(spark):
    evidence = [(2, 9, 0.9, 0.0), (9, 1, 0.9, 0.0), (9, 9, 0.5, 0.4), (9, 9, 0.9, 0.2), (9, 9, 0.9, 0.05), (9, 9, 0.1, 0.0)]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(evidence)], "i int, umi_cancer int, bc_cancer int, mcf_cancer double, mcf_noncancer double")
    got = [r.d for r in df.withColumn("d", fusion.decision(Fusion())).orderBy("i").collect()]
    assert got == ["Low_Cancer_UMI", "Low_Cancer_BC", "Low_delta_MCF", "High_Non-Cancer_MCF", "PASS", "PASS"]
    p = spark.createDataFrame([("a--b", 2, "ONLY_REF_SPLICE", "B1^U1^r1,B1^U2^r2"), ("a--b", 1, "ONLY_REF_SPLICE", "B1^U1^r3"), ("c--d", 3, "ONLY_REF_SPLICE", "B9^U1^r1"), ("e--f", 4, "OTHER", "B1^U1^r1")], "fusion string, ordinal int, SpliceType string, LR_accessions string")
    unfiltered, good, long = fusion.filter_fusions(p, spark.createDataFrame([("B1-1", "Cancer")], "cb string, cell_type string"), Fusion(1, 1))
    assert {r.fusion: (r.umi_cancer, r.mcf_noncancer) for r in unfiltered.collect()} == {"a--b1": (1, None), "a--b2": (2, None), "c--d": (0, None)}
    assert {r.fusion for r in good.collect()} == {"a--b1", "a--b2"} and long.count() == 3


def test_genotype_status_and_matrix(spark):
    base = [("chr1", 1, 0, 0, None), ("chr1", 1, 3, 0, None), ("chr1", 1, 3, 3, 0.0), ("chr1", 1, 9, 1, 0.5), ("chrM", 1, 9, 1, 0.5), ("chrM", 1, 4, 3, 0.5)]
    df = spark.createDataFrame([(i, c, p, d, a, a / d if d else None, q) for i, (c, p, d, a, q) in enumerate(base)], "i int, chrom string, pos int, dp int, n_alt int, vaf double, p double").withColumn("s", genotype.status(Genotype()))
    assert [r.s for r in df.orderBy("i").collect()] == ["NoCoverage", "NoAltReads", "PASS", "BetaBin_problem", "LowVAFChrM", "PASS"]
    long = spark.createDataFrame([(f"chr1:{k}:A", f"c{c}", 1 if c <= k else (0 if c < 9 else None)) for k in range(3, 8) for c in range(10)] + [("x--y", "c9", 1), ("x--y", "c1", 1)], "key string, cb string, mutated int")
    kept = genotype.filter_matrix(long, Matrix(5, 2)).collect()
    assert {r.key for r in kept} == {"chr1:5:A", "chr1:6:A", "chr1:7:A", "x--y"} and "c9" not in {r.cb for r in kept}
    wide = genotype.to_matrix(genotype.filter_matrix(long, Matrix(5, 2)), "mutated", ["c0", "c8"])
    assert {r.key: (r.c0, r.c8) for r in wide.collect()} == {"chr1:5:A": (1, 0), "chr1:6:A": (1, 0), "chr1:7:A": (1, 0), "x--y": (None, None)}
    order = ["chr2:5:A", "chr10:4:A", "chr10:11:A", "chrX:1:A", "chrM:1:A", "a--b"]
    shuffled = spark.createDataFrame([(k,) for k in sorted(order)], "key string")
    assert [r.key for r in shuffled.orderBy(*genotype.natural_order(F.col("key"))).collect()] == order


def test_intervals_by_hand(spark):
    a = spark.createDataFrame([("c", 0, 10), ("c", 10, 20), ("c", 22, 30), ("d", 5, 6)], "chrom string, start long, end long")
    assert sorted(map(tuple, intervals.merge(a, 0).collect())) == [("c", 0, 20), ("c", 22, 30), ("d", 5, 6)]
    assert sorted(map(tuple, intervals.merge(a, 2).collect())) == [("c", 0, 30), ("d", 5, 6)]
    b = spark.createDataFrame([("c", 3, 5), ("c", 4, 8), ("c", 18, 25)], "chrom string, start long, end long")
    assert sorted(map(tuple, intervals.subtract(a, b, 4).collect())) == [("c", 0, 3), ("c", 8, 10), ("c", 10, 18), ("c", 25, 30), ("d", 5, 6)]
    assert sorted(map(tuple, intervals.tile(a, 6).where("chrom = 'c' and end <= 10").collect())) == [("c", 0, 6), ("c", 6, 10)]


@pytest.mark.parametrize("width, gap", [(5, 0), (5, 7), (40, 3), (1000, 1)])
def test_merging_across_bins(spark, width, gap):
    rng = random.Random(width + gap)
    rows = [(c, s, s + rng.choice((0, 1, 3, 90))) for c in ("a", "b") for s in (rng.randrange(600) for _ in range(60))]
    want = []
    for c, s, e in sorted(rows):
        if want and want[-1][0] == c and s <= want[-1][2] + gap:
            want[-1][2] = max(want[-1][2], e)
        else:
            want.append([c, s, e])
    df = spark.createDataFrame([*rows, ("a", None, 4), ("a", 4, None)], "chrom string, start long, end long")
    assert sorted(map(list, intervals.merge(df, gap, width).collect())) == want


def test_neighbours_across_bins(spark, monkeypatch):
    monkeypatch.setattr(calling, "NEAR_BIN", 7)
    rng = random.Random(3)
    places = sorted({(c, rng.randrange(400)) for c in ("chr1", "chr2", "chrM") for _ in range(70)})
    df = spark.createDataFrame([(c, p, "A", p % 3 > 0) for c, p in places], "chrom string, pos long, alt string, kept boolean")
    for distance in (1, 3, 6, 20):
        near = {(r.chrom, r.pos): r.near for r in calling.near_in_order(df, "near", distance).collect()}
        assert near == {(c, p): any(d == c and 0 < abs(p - q) <= distance for d, q in places) for c, p in places}
        close = {(r.chrom, r.pos): r.close for r in calling.close_pairs(df, "close", distance, among=F.col("kept")).collect()}
        assert close == {(c, p): c != "chrM" and any(d == c and p != q and abs(p - q) < distance and (p % 3 > 0) == (q % 3 > 0) for d, q in places) for c, p in places}
    nowhere = spark.createDataFrame([("chr1", None, "A"), ("chr1", None, "C")], "chrom string, pos long, alt string")
    assert [r.near for r in calling.near_in_order(nowhere, "near", 5).collect()] == [False, False]


def test_text_tables_round_trip(spark, tmp_path):
    df = counts(spark, ("chr1", 1, "A", "Cancer", 50, 40, (20, 30), (20, 25)), ("chr2", 2, "C", "Non-Cancer", 9, 8, (0, 9), (0, 8)))
    key = lambda r: (r.chrom, r.pos, r.cell_type, r.dp, r.nc, tuple(r.bc), tuple(r.cc), tuple(r.bcf), tuple(r.bcr))
    assert {key(r) for r in tables.unpack(tables.pack(df)).collect()} == {key(r) for r in df.collect()}
    wide = tables.merged_wide(df, ["Cancer", "Non-Cancer"])
    tables.write_table(wide, f"{tmp_path}/wide", order=["chrom", "Start"])
    back = tables.read_table(spark, f"{tmp_path}/wide")
    assert back.columns == ["chrom", "Start", "End", "ref", "Cancer", "Non-Cancer"] and {r["Cancer"] == "NA" for r in back.collect()} == {True, False}
    text = tables.call_columns(calling.call_sites(df)).where("Start = 1").first()
    assert (text.ALT, text.FILTER, text.Bc, text.Cell_types) == ("C", "Min_cell_types", "30", "Cancer")
    (tmp_path / "g.gtf").write_text('##x\nchr1\th\tgene\t1\t9\t.\t+\t.\tgene_id "E1"; gene_name "N1";\nchr1\th\texon\t1\t9\t.\t+\t.\tgene_id "E1"; gene_name "N1";\n')
    assert [tuple(r) for r in tables.read_genes(spark, f"{tmp_path}/g.gtf").collect()] == [("E1", "N1")]
    (tmp_path / "m.tsv").write_text("key\ta\tb\nk1\t1\t3\nk2\t2\t.\n")
    m = {(r.key, r.cb): r.value for r in tables.read_matrix(spark, f"{tmp_path}/m.tsv").collect()}
    assert m == {("k1", "a"): 1.0, ("k1", "b"): None, ("k2", "a"): 1.0, ("k2", "b"): None}
    (tmp_path / "s.tsv").write_text("#chrom\tpos\nchr1\t4\nchr1\t4\n")
    assert [tuple(r) for r in tables.read_sites(spark, f"{tmp_path}/s.tsv").collect()] == [("chr1", 4)]
    (tmp_path / "c.tsv").write_text("# cmd\n")


def test_clusters_are_found(spark):
    rng = random.Random(1)
    profile = {k: [rng.random() < 0.5 for _ in range(24)] for k in range(3)}
    rows = [(c, m, int(profile[c % 3][m]) if rng.random() > 0.03 else int(not profile[c % 3][m])) for c in range(60) for m in range(24) if rng.random() > 0.1]
    data = spark.createDataFrame(rows, "cell long, mut long, value int").repartition(4, "cell").coalesce(4)
    trace = posterior.sample_posterior(data, Clustering(steps=10, chains=2, burn_in=0.6, seed=5), clusters=8)
    found = clustering.consensus(trace).withColumn("true", F.col("cell") % 3)
    assert found.count() == 60 and metrics.adjusted_rand(found, "cluster", "true").first().ari > 0.8
    called = clustering.cluster_genotypes(data, found.select("cell", "cluster"))
    assert called.count() > 0 and {r.chain for r in clustering.newest(trace).collect()} == {0, 1}


def test_panel_counts_samples(spark):
    df = spark.createDataFrame([("a", "chr1", 1, ["x"]), ("b", "chr1", 1, []), ("c", "chr1", 1, None), ("a", "chr2", 1, ["x"])], "sample_id string, chrom string, pos long, filters array<string>")
    assert [tuple(r) for r in cohort.panel_of_normals(df, 2).collect()] == [("chr1", 1, 2, "a,b")]


@pytest.mark.parametrize("strict", [False, True])
def test_order_of_close_pairs(spark, strict):
    df = spark.createDataFrame([("chr1", p, "A") for p in (999, 1001, 5000, 99)] + [("chrM", 1, "A"), ("chrM", 2, "A")], "chrom string, pos long, alt string")
    got = {(r.chrom, r.pos): r.close for r in calling.close_pairs(df, "close", 10, strict).collect()}
    # As text 1001, 5000, 99, 999: 999 and 1001 are no neighbours.
    assert got["chr1", 999] is (not strict) and not got["chrM", 1]


def test_chains_and_outputs(spark):
    from cytoflux.functions import chains
    from cytoflux.sources import outputs

    assert abs(chains.psrf_cutoff(0.05) - 1.0000813) < 1e-6
    assert chains.tree_edges("((a:1,b:2):0.5,c)r;") == [("n0", "a", 1.0), ("n0", "b", 2.0), ("r", "n0", 0.5), ("r", "c", 0.0)]
    clusters = spark.createDataFrame([(2, 1), (1, 0), (3, 1)], "cell long, cluster int")
    assert outputs.assignments(clusters).first().Assignment == "0 1 1"
    genos = spark.createDataFrame([(0, 5, 0.25, 0), (1, 5, 0.75, 1)], "cluster int, mut long, theta double, called int")
    assert {(r.cell, r.called) for r in outputs.genotypes_of_cells(clusters, genos).collect()} == {(1, 0), (2, 1), (3, 1)}
    calls = site_of(spark, ("chr4", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chr4", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)))
    row = outputs.final_calls(calling.finalize_calls(calls, Final())).first()
    assert (row.STEP3FILTER, row.INDEX, row.Bc) == ("PASS", "chr4:1000:C", "50")
    packed = outputs.base_counts(counts(spark, ("chr1", 1, "A", "c", 9, 8, (9,), (8,)))).first()
    assert packed.info.startswith("9|8|8:0:0:0:0:0|9:0:0:0:0:0")
    g = spark.createDataFrame([("chr1", 1, "A", "C", "b", "t", 0, 0, None, None, "NoCoverage", None, "k")], "chrom string, pos long, ref string, alt string, cb string, cell_type string, dp long, n_alt long, vaf double, p double, status string, mutated int, key string")
    assert (outputs.genotype_rows(g).first().VAF, outputs.genotype_rows(g).first().BinMutationStatus) == (".", 3)
    assert outputs.panel_rows(spark.createDataFrame([("1", 2, 3, "a,b")], "chrom string, pos long, n_samples long, samples string")).columns[0] == "#CHROM"


def test_tail_of_deep_sites(spark):
    """Both sides, where the sum over one of them would be long; the logarithm of the gamma function."""
    rows = [(k, n) for n in (1, 7, 1000, 200_000) for k in {1, 2, n // 2, n - 1, n} if 0 < k <= n]
    df = spark.createDataFrame([r for r in rows if min(r[0], r[1] - r[0]) < 2000], "k long, n long").withColumn("p", betabinom.tail(F.col("k"), F.col("n"), 0.2, 105.0))
    for r in df.collect():
        lg = math.lgamma
        terms = lambda xs: sum(math.exp(lg(r.n + 1) - lg(i + 1) - lg(r.n - i + 1) + lg(i + 0.2) + lg(r.n - i + 105.0) - lg(r.n + 105.2) - lg(0.2) - lg(105.0) + lg(105.2)) for i in xs)
        want = 1 - terms(range(r.k)) if r.k < r.n / 2 else terms(range(r.k, r.n + 1))
        assert abs(r.p - want) < 1.1e-4, r
    deep = spark.createDataFrame([(100_000, 99_000, 50_000, 51_000)], "a long, b long, c long, d long")
    assert deep.select(betabinom.fisher(*map(F.col, "abcd")).alias("p")).first().p == 0.0001  # z = 3.86
    x = spark.createDataFrame([(v,) for v in (0.05, 0.5, 1.0, 3.5, 40.0, 1e6)], "x double").withColumn("l", betabinom.log_gamma(F.col("x")))
    assert all(abs(r.l - math.lgamma(r.x)) < 1e-9 * max(1, abs(r.l)) for r in x.collect())


def test_regions_and_samples_are_counted_apart(spark):
    rows = [(s, "chr1", p, "A", "C", 30, 60, f"c{i}", "Cancer", False, False, False, False) for s in "ab" for p in (99, 100, 150, 199, 200) for i in range(2 if s == "a" else 3)]
    names = "sample_id string, chrom string, pos long, ref string, raw_base string, base_qual int, map_qual int, cb string, cell_type string, is_reverse boolean, is_secondary boolean, is_duplicate boolean, is_supplementary boolean"
    df = spark.createDataFrame(rows, names)
    regions = spark.createDataFrame([("chr1", 100, 200), ("chr1", 120, 180), ("chr2", 0, 999)], "chrom string, start long, end long")
    excluded = spark.createDataFrame([("chr1", 150, 151)], regions.schema)
    got = pileup.count_bases(df, Counting(min_dp=1, min_cc=1), keys=("sample_id",), regions=regions, excluded=excluded)
    assert {(r.sample_id, r.pos): (r.dp, r.nc) for r in got.collect()} == {("a", 100): (2, 2), ("a", 199): (2, 2), ("b", 100): (3, 3), ("b", 199): (3, 3)}


def test_natural_rank(spark):
    keys = ["chr10:5:A", "chr2:7:A", "chr2:5000000:A", "chrX:1:A", "chrM:2:A", "g1--g2", "chr2:7:C"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    want = ["chr2:7:A", "chr2:7:C", "chr2:5000000:A", "chr10:5:A", "chrX:1:A", "chrM:2:A", "g1--g2"]
    assert [r.key for r in genotype.natural_rank(df).orderBy("place").collect()] == want


def test_missing_files_are_skipped(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("chr1\t5\n#x\nchr2\t6\n")
    got = tables.read_files(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "gone.tsv")], "chrom string, pos long")
    assert sorted((r.chrom, r.pos, r.path.endswith("a.tsv")) for r in got.collect()) == [("chr1", 5, True), ("chr2", 6, True)]
    none = tables.read_files(spark, [str(tmp_path / "gone.tsv")], "chrom string, pos long")
    assert none.columns == ["chrom", "pos", "path"] and none.count() == 0
    (tmp_path / "b.tsv").write_text("## c\n#name\tn\n\t1\nx\t2\n")
    assert {tuple(r) for r in tables.read_table(spark, str(tmp_path / "b.tsv")).collect()} == {(None, "1"), ("x", "2")}


def test_call_tables_are_read_back(spark, tmp_path):
    """The next step gives the same from the file as from the calls themselves."""
    from cytoflux.sources import outputs

    calls = site_of(
        spark,
        ("chr1", 1000, "A", "Cancer", 100, 60, (50, 49, 1), (40, 30, 1)), ("chr1", 1000, "A", "Non-Cancer", 50, 40, (50,), (40,)),
        ("chr4", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chr4", 1000, "A", "Non-Cancer", 50, 40, (40, 10), (40, 9)),
        ("chr5", 1000, "A", "Cancer", 100, 60, (50, 50), (40, 30)), ("chrM", 7, "A", "Cancer", 200, 60, (100, 100), (40, 30)),
        ("chr6", 1, "A", "Cancer", 50, 40, (50,), (40,)), ("chr6", 1, "A", "Non-Cancer", 50, 40, (50,), (40,)),
    )
    tables.write_table(tables.call_columns(calls, ["Cancer", "Non-Cancer"]), f"{tmp_path}/calls", order=["#CHROM", "Start"])
    back = tables.read_calls(spark, f"{tmp_path}/calls")
    same = ["chrom", "pos", "ref", "n_callable", "rest_bc", "rest_dp", "rest_cc", "rest_nc", "p_noise_bc", "p_noise_cc", "calls", "counts", "up", "down", "n_alts", "filters"]
    by_site = lambda df: sorted(map(str, df.select(*same).collect()))
    assert by_site(back) == by_site(calls) and len(by_site(back)) == 5
    final = lambda df: sorted(map(str, outputs.final_calls(calling.finalize_calls(df, Final())).collect()))
    assert final(back) == final(calls) and final(calls)
    found = lambda df: sorted(map(str, outputs.hccv_calls(hccv.hccv_candidates(df, Hccv())).collect()))
    assert found(back) == found(calls) and "HCCV_FILTER='" in found(calls)[0]
    tables.write_table(tables.call_columns(calls), f"{tmp_path}/bare")
    assert {len(r.counts) for r in tables.read_calls(spark, f"{tmp_path}/bare").collect()} == {0}


def test_small_tables_are_read(spark, tmp_path):
    from cytoflux.sources import outputs

    tables.write_table(outputs.parameters(spark, Calling.reads_ab, Calling.cells_ab), f"{tmp_path}/p")
    assert tables.read_parameters(spark, f"{tmp_path}/p") == dict(zip(("alpha1", "beta1", "alpha2", "beta2"), (*Calling.reads_ab, *Calling.cells_ab)))
    (tmp_path / "samples.tsv").write_text("sample\tkind\na\tx\nb\ty\n")
    assert [tuple(r) for r in tables.read_samples(spark, f"{tmp_path}/samples.tsv").orderBy("sample_id").collect()] == [("a", "x"), ("b", "y")]
    (tmp_path / "f.tsv").write_text("#FusionName\tSpliceType\tLR_accessions\na--b\tONLY_REF_SPLICE\tB1^U1^r1,B1^U2^r2\nc--d\tOTHER\tB1^U1^r1\na--b\tONLY_REF_SPLICE\tB1^U1^r3\n")
    fusions, good, long = fusion.filter_fusions(tables.read_fusions(spark, f"{tmp_path}/f.tsv"), spark.createDataFrame([("B1-1", "Cancer")], "cb string, cell_type string"), Fusion(1, 1))
    assert {r.fusion: r.umi_cancer for r in fusions.collect()} == {"a--b1": 2, "a--b2": 1} and long.count() == 3


@pytest.mark.parametrize("sep", ["\t", ",", " "])
@pytest.mark.parametrize(("header", "named"), [(False, False), (True, False), (True, True)])
def test_matrices_are_told_apart(spark, tmp_path, sep, header, named):
    rows, cells = [["0", "2", "3"], ["1", "3", "0"]], ["ca", "cb", "cc"]
    lines = [[*(["id"] if named else []), *cells]] if header else []
    lines += [[*([f"m{i}"] if named else []), *r] for i, r in enumerate(rows)]
    (tmp_path / "m.txt").write_text("".join(sep.join(x) + "\n" for x in lines))
    got = {(r.key, r.cb): r.value for r in tables.read_any_matrix(spark, f"{tmp_path}/m.txt").collect()}
    value = {"0": 0.0, "1": 1.0, "2": 1.0, "3": None}
    assert got == {(f"m{i}" if named else str(i), cells[j] if header else str(j)): value[x] for i, r in enumerate(rows) for j, x in enumerate(r)}


def test_genotypes_are_averaged(spark):
    """Exactly the cluster's cells in one sample; all of them with others; nowhere together."""
    samples = {0: "aabbccdd", 1: "aabbbbcd", 2: "abbbcccc"}  # eight cells
    consensus = [0, 0, 1, 1, 1, 1, 2, 2]
    trace = spark.createDataFrame([(s, c, ord(x)) for s, line in samples.items() for c, x in enumerate(line)], "sample int, cell int, cluster int")
    thetas = spark.createDataFrame([(s, ord(x), 0, (s + 1) * 0.1 + 0.01 * (ord(x) - 97)) for s, line in samples.items() for x in set(line)], "sample int, cluster int, mut int, theta double")
    of = lambda s, x: (s + 1) * 0.1 + 0.01 * (ord(x) - 97)
    got = {r.cluster: r.theta for r in clustering.averaged_genotypes(trace, thetas, spark.createDataFrame(list(enumerate(consensus)), "cell int, cluster int")).collect()}
    want = {0: (of(0, "a") + of(1, "a")) / 2, 1: of(1, "b"), 2: of(0, "d")}
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and set(got) == {0, 1, 2}
    apart = spark.createDataFrame([(0, 0), (3, 0), (7, 0)], "cell int, cluster int")
    want = sum(of(s, samples[s][c]) for s in samples for c in (0, 3, 7)) / 9
    assert abs(clustering.averaged_genotypes(trace, thetas, apart).first().theta - want) < 1e-12
    data = spark.createDataFrame([(c, 0, int(c < 2)) for c in range(8)] + [(0, 1, None)], "cell int, mut int, value int")
    assert {(r.cluster, round(r.theta, 3)) for r in clustering.trace_profiles(data, trace.where("sample = 0")).collect()} == {(97, 0.75), (98, 0.25), (99, 0.25), (100, 0.25)}


def test_hamming_either_way(spark):
    one = spark.createDataFrame([(0, 0, 1), (0, 1, 1), (1, 0, 0), (1, 1, 0)], "cell int, mut int, value int")
    turned = one.select(F.col("mut").alias("cell"), F.col("cell").alias("mut"), "value")
    assert metrics.hamming(one, turned).first().n_differ == 2 and metrics.hamming(one, turned, either_way=True).first().n_differ == 0
