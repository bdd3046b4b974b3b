"""Deep sites cut to their greatest depth, and matrices with a column per cell."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cytoflux.operators import genotype, pileup
from cytoflux.plans.params import Counting, Matrix
from cytoflux.sources import tables


def test_at_most(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") < 50_000, 1).otherwise(F.col("id") % 500 + 2).alias("pos"), F.lit("chr1").alias("chrom"), (F.col("id") % 5000).alias("x"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("y"))
    for most in (1, 15, 700, 49_999, 50_000, 70_000):
        cut = pileup.at_most(rows, ("chrom", "pos"), most)
        assert cut.columns == rows.columns
        got = {r.pos: r.n for r in cut.groupBy("pos").agg(F.count("*").alias("n")).collect()}
        want = {r.pos: min(r.n, most) for r in rows.groupBy("pos").agg(F.count("*").alias("n")).collect()}
        assert got == want and cut.exceptAll(rows).isEmpty()
    again = pileup.at_most(rows.repartition(7, "x"), ("chrom", "pos"), 700)
    assert again.exceptAll(pileup.at_most(rows, ("chrom", "pos"), 700)).isEmpty()
    assert pileup.at_most(rows.limit(0), ("chrom", "pos"), 5).count() == 0


def test_ten_million_reads_on_one_site(spark):
    rows = spark.range(10_000_000).select(F.lit("chr1").alias("chrom"), F.lit(5).alias("pos"), F.col("id").alias("read"))
    assert pileup.at_most(rows, ("chrom", "pos"), 200_000).count() == 200_000


def test_depth_of_a_pileup(spark):
    rows = [("chr1", 1, "A", f"c{i}", "A", 30, 60) for i in range(50)] + [("chr1", 2, "A", "c1", "C", 30, 60)] * 3
    df = spark.createDataFrame(rows, "chrom string, pos long, ref string, cb string, raw_base string, base_qual int, map_qual int")
    got = {r.pos: r.n for r in pileup.pileup(df, Counting(min_bq=5, min_mq=5, max_depth=20)).groupBy("pos").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 20, 2: 3}


def long_matrix(seed, keys, cells):
    rng = random.Random(seed)
    return [(f"chr{k % 3}:{k}:A" if k % 5 else f"g{k}--h", f"c{c:04d}", rng.choice([0, 1, 1, None])) for k in range(keys) for c in range(cells) if rng.random() < 0.3]


def test_dense_filter_is_the_filter_of_dense_rows(spark):
    rows = long_matrix(1, 30, 40)
    long = spark.createDataFrame(rows, "key string, cb string, mutated int")
    fused = lambda k: "--" in k
    n = {k: sum(m == 1 for x, _, m in rows if x == k) for k, _, _ in rows if not fused(k)}
    keys = {k for k in n if n[k] > 5}
    cells = {c for c in {c for _, c, _ in rows} if sum(x in keys and y == c and m is not None for x, y, m in rows) > 4}
    known = {(k, c): m for k, c, m in rows}
    want = {(k, c, known.get((k, c))) for k in keys for c in cells} | {(k, c, m) for k, c, m in rows if fused(k) and c in cells}
    dense = genotype.filter_matrix(long, Matrix(5, 4), dense=True)
    assert {tuple(r) for r in dense.collect()} == want and dense.count() == len(want) and keys and cells
    assert {tuple(r) for r in genotype.filter_matrix(long, Matrix(5, 4)).collect()} == {(k, c, m) for k, c, m in rows if c in cells and (k in keys or fused(k))}
    plan = dense._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_wide_rows_are_read_back(spark, tmp_path):
    rows = long_matrix(2, 25, 90)
    covered = spark.createDataFrame(rows, "key string, cb string, mutated int")
    keys = spark.createDataFrame([(k,) for k in sorted({k for k, _, _ in rows} | {"chr9:9:T"})], "key string")
    cells = spark.createDataFrame([(f"c{c:04d}",) for c in range(95)], "cb string")
    for width in (7, 4096):
        header, lines = genotype.wide_rows(keys, covered, cells, "mutated", width=width)
        text = {r.key: r.line for r in lines.collect()}
        (tmp_path / f"m{width}.tsv").write_text("\n".join([header, *(text[k] for k in sorted(text))]) + "\n")
        back = {(r.key, r.cb): r.value for r in tables.read_any_matrix(spark, f"{tmp_path}/m{width}.tsv").collect()}
        known = {(k, c): m for k, c, m in rows}
        assert back == {(k, f"c{c:04d}"): (None if known.get((k, f"c{c:04d}")) is None else float(known[k, f"c{c:04d}"])) for k in text for c in range(95)}


def test_a_hundred_thousand_cells(spark):
    cells = spark.range(100_000).select(F.format_string("c%06d", "id").alias("cb"))
    keys = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    covered = cells.where("cb LIKE '%7'").select(F.lit("k1").alias("key"), "cb", F.lit(1).alias("mutated"))
    header, lines = genotype.wide_rows(keys, covered, cells, "mutated", missing=".")
    got = {r.key: r.line.split("\t") for r in lines.collect()}
    assert len(header.split("\t")) == 100_001 and set(got) == {"k1", "k2", "k3"} and all(len(x) == 100_001 for x in got.values())
    assert got["k1"][1:].count("1") == 10_000 and got["k1"][8] == "1" and set(got["k2"][1:]) == {"."}


def test_dense_rows_are_not_shuffled(spark):
    rows = spark.createDataFrame([(f"k{k}", k) for k in range(7)], "key string, n int")
    cells = spark.createDataFrame([(f"c{c}", "x") for c in range(300)], "cb string, cell_type string")
    covered = spark.createDataFrame([("k1", "c5"), ("k1", "c5"), ("k1", "c299"), ("k3", "other"), ("k99", "c1")], "key string, cb string")
    every = genotype.uncovered(rows, cells, covered, ["key"], width=16)
    want = {(f"k{k}", k, f"c{c}", "x") for k in range(7) for c in range(300)} - {("k1", 1, "c5", "x"), ("k1", 1, "c299", "x")}
    assert {tuple(r) for r in every.collect()} == want and every.count() == len(want)
    assert genotype.uncovered(rows, cells.limit(0), covered, ["key"]).count() == genotype.uncovered(rows.limit(0), cells, covered, ["key"]).count() == 0
    above = every._jdf.queryExecution().executedPlan().toString().split("Generate posexplode", 1)
    assert len(above) == 2 and "Exchange" not in above[0] and "Join" not in above[0]


def test_tasks_follow_the_reads(spark, monkeypatch):
    """However well rows compress, a task gets no more of them as tables grow."""
    reads = spark.range(20_000).select(F.concat(F.lit("chr"), (F.col("id") % 5).cast("string")).alias("chrom"), (F.col("id") % 1000).alias("pos"), F.substring(F.lit("AGT"), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("ref"), F.lit("C").alias("raw_base"), F.lit(30).alias("base_qual"), F.lit(60).alias("map_qual"), F.concat(F.lit("c"), (F.col("id") % 50).cast("string"), F.lit("-1")).alias("cb"), *[F.lit(False).alias(f"is_{k}") for k in ("reverse", "secondary", "duplicate", "supplementary")])
    variants = reads.select("chrom", "pos", F.lit("A").alias("ref"), F.col("raw_base").alias("alt")).distinct()
    cells = spark.range(50).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cb"), F.lit("x").alias("cell_type"))
    monkeypatch.setattr(genotype, "ROWS", 1000)
    for most in (10, 10_000):
        monkeypatch.setattr(genotype, "BROADCAST", most)
        found = genotype.genotype_cells(variants, reads, cells, dense=False)
        assert found.agg(F.sum("dp")).first()[0] == 20_000
        assert found.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.sum("dp").alias("n")).agg(F.max("n")).first()[0] < 4000


def test_dense_rows_shuffle_no_slices(spark, monkeypatch):
    """With few cells, rows are multiplied by slices behind the shuffle, and covered cells are shuffled once."""
    rows = spark.createDataFrame([(f"k{k}", k) for k in range(7)], "key string, n int")
    cells = spark.createDataFrame([(f"c{c}", "x") for c in range(300)], "cb string, cell_type string")
    covered = spark.createDataFrame([("k1", "c5"), ("k1", "c5"), ("k1", "c299"), ("k3", "other"), ("k99", "c1")], "key string, cb string")
    every = genotype.uncovered(rows, cells, covered, ["key"], width=16)
    plan = every._jdf.queryExecution().executedPlan().toString()
    assert "slice_" not in "".join(line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "key" in line)
    monkeypatch.setattr(genotype, "CELLS", 10)
    want = genotype.uncovered(rows, cells, covered, ["key"], width=16)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, want.collect())) and every.count() == 7 * 300 - 2


def test_reads_of_a_dense_grid_are_shuffled_once(spark):
    flags = {f"is_{k}": F.lit(False) for k in ("reverse", "secondary", "duplicate", "supplementary")}
    reads = spark.range(400).select(F.lit("chr1").alias("chrom"), (F.col("id") % 10).alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("raw_base"), F.lit(30).alias("base_qual"), F.lit(60).alias("map_qual"), F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("cb")).withColumns(flags)
    variants = spark.range(12).select(F.lit("chr1").alias("chrom"), F.col("id").alias("pos"), F.lit("A").alias("ref"), F.lit("C").alias("alt"))
    cells = spark.range(9).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("cb"), F.lit("x").alias("cell_type"))
    grid = genotype.genotype_cells(variants, reads, cells)
    assert grid.count() == grid.select("key", "cb").distinct().count() == 12 * 9 and grid.agg(F.sum("dp")).first()[0] == 400
    assert "raw_base" not in grid._jdf.queryExecution().optimizedPlan().toString()


def test_dense_filter_reads_its_rows_once(spark):
    """The fusions of the result came from all genotypes once more, with their shuffle of the reads."""
    long = spark.createDataFrame(long_matrix(3, 30, 40), "key string, cb string, mutated int").repartition(3, "key").withColumn("mutated", F.col("mutated") + 0)
    plan = genotype.filter_matrix(long, Matrix(5, 4), dense=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan and "LocalRelation" not in plan and "Relation" in plan
