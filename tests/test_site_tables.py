"""Tables by site: plans without a shuffle, and directories that regions leave out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cytoflux.operators import genotype, pileup
from cytoflux.plans import adapter, queries
from cytoflux.plans.params import Counting, Genotype
from cytoflux.sources import site_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    names = ("site_reads", "site_variants")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    site_tables.write_sites(adapter.read_bases(spark, SF), names[0], 500, 4)
    site_tables.write_sites(queries.variants(spark, SF), names[1], 500, 4)
    yield names
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_counts_and_genotypes_without_a_shuffle(spark, tables):
    counting = Counting(min_bq=5, min_dp=2, min_cc=1)
    reads, variants = (site_tables.read_sites_table(spark, n) for n in tables)
    counted = pileup.count_bases(reads, counting)
    assert "Exchange" not in plan(counted) and rows(counted) == rows(pileup.count_bases(adapter.read_bases(spark, SF), counting))
    cells = genotype.cell_counts(variants, reads, Genotype(min_bq=5))
    assert "Exchange" not in plan(cells) and "SortMergeJoin" in plan(cells)
    assert rows(cells) == rows(genotype.cell_counts(queries.variants(spark, SF), adapter.read_bases(spark, SF), Genotype(min_bq=5)))


def test_regions_read_their_directories(spark, tables):
    all_rows = adapter.read_bases(spark, SF)
    part = site_tables.read_region(spark, tables[0], "chr5", 400, 900, 500)
    assert rows(part) == rows(all_rows.where("chrom = 'chr5' AND pos >= 400 AND pos < 900")) and part.count()
    files, some = (len(df.inputFiles()) for df in (spark.table(tables[0]), part))
    assert 0 < some < files / 8
    regions = spark.createDataFrame([("chr5", 400, 900), ("chr7", 0, 300), ("chr7", 200, 450), ("chrX", 1, 9), ("chr1", 7, 7)], "chrom string, start long, end long")
    got = site_tables.read_regions(spark, tables[0], regions, 500)
    assert rows(got) == rows(all_rows.where("(chrom = 'chr5' AND pos >= 400 AND pos < 900) OR (chrom = 'chr7' AND pos < 450)"))


def test_rows_without_a_site(spark, tables):
    df = spark.createDataFrame([("chr1", 5), (None, 5), ("chr1", None)], "chrom string, pos long")
    site_tables.write_sites(df.withColumn("x", F.lit(1)), "site_odd", 10, 2)
    assert [tuple(r) for r in site_tables.read_sites_table(spark, "site_odd").select("chrom", "pos", "x").collect()] == [("chr1", 5, 1)]
    spark.sql("DROP TABLE site_odd")
