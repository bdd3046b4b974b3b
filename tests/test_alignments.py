"""CIGAR expansion token by token against a plain walk, and FASTA files in splits of any size."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cytoflux.operators import alignments, calling, pileup
from cytoflux.plans.params import Counting
from cytoflux.sources import fasta

READS = "id long, chrom string, pos long, cigar string, seq string, qual array<int>, is_reverse boolean, cb string"


def walk(pos, cigar, seq, quals, reverse):
    """(place, token, quality) of a read, base by base."""
    ops = [(int(n), op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or "") if op not in "HP"]
    at, q, out = pos, 0, []
    for k, (n, op) in enumerate(ops):
        after_n, after = ops[k + 1] if k + 1 < len(ops) else (0, "")
        for o in range(n if op in "MDN=X" else 0):
            behind = ""
            if o == n - 1 and after == "I":
                behind = f"+{after_n}{seq[q + (n if op in 'M=X' else 0):][:after_n]}"
            elif o == n - 1 and after == "D" and op != "D":
                behind = f"-{after_n}{'N' * after_n}"
            mine = q + o if op in "M=X" else q
            base = seq[mine] if op in "M=X" else "*" if op == "D" else "<" if reverse else ">"
            if op != "N" or behind.startswith("+"):
                out.append((at + o, (base + behind).lower() if reverse else (base + behind).upper(), quals[mine] if mine < len(quals) else None))
        at += n if op in "MDN=X" else 0
        q += n if op in "MIS=X" else 0
    return out


def random_read(rng, i, n_ops):
    ops = []
    while len(ops) < n_ops:
        op = rng.choice("MMMM=XIDNP")
        if not ops or ops[-1][1] != op:
            ops.append((rng.randrange(1, 6), op))
    ops = [(3, "H"), (2, "S"), *ops, (1, "M"), (4, "S")]
    length = sum(n for n, op in ops if op in "MIS=X")
    return (i, "chr1", rng.randrange(1, 1000), "".join(f"{n}{op}" for n, op in ops), "".join(rng.choice("ACGTacgtN") for _ in range(length)), [rng.randrange(41) for _ in range(length)], rng.random() < 0.5, f"c{i}")


@pytest.mark.parametrize("block", [1, 3, alignments.BLOCK])
def test_tokens(spark, block):
    rng = random.Random(block)
    reads = [random_read(rng, i, rng.randrange(1, 30)) for i in range(150)] + [random_read(rng, 500, 700)]
    reads += [(900, "chr1", 5, "*", "ACG", [1, 2, 3], False, "c"), (901, "chr1", 5, None, "ACG", [1], False, "c"), (902, "chr1", None, "3M", "ACG", [1], False, "c"), (903, "chr1", 5, "3M", "*", [], False, "c"), (904, "chr1", 5, "3M", None, None, False, "c"), (905, "chr1", 5, "3S", "ACG", [1, 2, 3], True, "c"), (906, "chr1", 5, "3M", "ACG", None, False, None), (907, "chr1", 5, "3M4D", "ACG", [1, 2, 3], None, "c"), (908, "chr1", 5, "0M2M", "AC", [1, 2], False, "c")]
    df = spark.createDataFrame(reads, READS)
    out = alignments.read_bases(df, block)
    assert out.columns == ["id", "chrom", "is_reverse", "cb", "pos", "raw_base", "base_qual"]
    got: dict = {}
    for r in out.collect():
        got.setdefault(r.id, []).append((r.pos, r.raw_base, r.base_qual))
    want = {i: walk(pos, cigar, seq, quals, rev) for i, _, pos, cigar, seq, quals, rev, _ in reads if i < 900}
    want[906], want[908] = [(5, "A", None), (6, "C", None), (7, "G", None)], [(5, "A", 1), (6, "C", 2)]
    want[907] = walk(5, "3M4D", "ACG", [1, 2, 3], False)
    assert {i: sorted(t, key=str) for i, t in got.items()} == {i: sorted(t, key=str) for i, t in want.items() if t}
    assert alignments.read_bases(df.limit(0)).count() == 0


def test_text_qualities_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, "chr1", 5, "1S2M", "ACG", "!I5", False)], "id int, chrom string, pos long, cigar string, seq string, qual string, is_reverse boolean")
    out = alignments.read_bases(df)
    assert [(r.pos, r.raw_base, r.base_qual) for r in out.collect()] == [(5, "C", 40), (6, "G", 20)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_long_reads_take_linear_time(spark):
    """20,000 operations of one read."""
    n = 10_000
    df = spark.createDataFrame([(1, 1, "1M1I" * n, "AC" * n, [30] * (2 * n), False)], "id int, pos long, cigar string, seq string, qual array<int>, is_reverse boolean")
    assert alignments.read_bases(df).agg(F.count("*"), F.max("pos"), F.min("raw_base"), F.max("raw_base")).first() == (n, n, "A+1C", "A+1C")


def write_fasta(path, records, width, rng):
    lines = []
    for name, seq in records:
        lines.append(f">{name} some words")
        lines += [seq[i : i + width] for i in range(0, len(seq), width)]
        lines += rng.choice([[], [""], ["; a comment"]])
    path.write_text("\n".join(lines) + rng.choice(["", "\n"]))


@pytest.mark.parametrize("split", ["37", "200", "128m"])
@pytest.mark.parametrize("width", [7, 60, 100_000])
def test_fasta(spark, tmp_path, split, width):
    rng = random.Random(width)
    records = [(f"{f}{k}", "".join(rng.choice("ACGTNacgt") for _ in range(rng.choice([1, 19, 20, 21, 40, 333, 1000])))) for f in "ab" for k in range(4)] + [("empty", "")]
    write_fasta(tmp_path / "a.fa", [r for r in records if r[0][0] == "a"], width, rng)
    write_fasta(tmp_path / "b.fa", [r for r in records if r[0][0] != "a"], width, rng)
    size, flank = 20, 5
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        chunks = fasta.read_fasta(spark, [str(tmp_path / "a.fa"), str(tmp_path / "b.fa")], size, flank)
        got = {(r.chrom, r.chunk): r.seq for r in chunks.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {(name, c): seq.upper()[max(c * size - flank, 0) : (c + 1) * size + flank] for name, seq in records for c in range(-(-len(seq) // size))}
    assert got == want


def test_context_and_bases_from_a_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fasta, "PIECE", 16)
    rng = random.Random(1)
    seq = "".join(rng.choice("ACGT") for _ in range(2000))
    write_fasta(tmp_path / "r.fa", [("chr1", seq)], 61, rng)
    chunks = fasta.read_fasta(spark, str(tmp_path / "r.fa"), 50)
    sites = spark.createDataFrame([("chr1", p) for p in (1, 3, 6, 49, 50, 51, 777, 1995, 2000)] + [("chrX", 5)], "chrom string, pos long")
    for r in calling.reference_context(sites, chunks, 50).collect():
        want = (".", ".") if r.chrom == "chrX" else (seq[max(r.pos - 6, 0) : r.pos - 1], seq[r.pos : r.pos + 5])
        assert (r.up, r.down) == want
    reads = spark.createDataFrame([(i, "chr1", 48, "6M", "ACGTAC", [40] * 6, False, f"c{i}") for i in range(6)] + [(9, "chr1", 1999, "4M", "ACGT", [40] * 4, True, "c9")], READS)
    bases = alignments.with_reference(alignments.read_bases(reads), chunks, 50).withColumns({c: F.lit(False) for c in ("is_secondary", "is_duplicate", "is_supplementary")}).withColumns({"map_qual": F.lit(60), "cell_type": F.lit("x")})
    assert {(r.pos, r.ref) for r in bases.collect()} == {(p, seq[p - 1]) for p in [*range(48, 54), 1999, 2000]} | {(2001, "N"), (2002, "N")}
    counted = pileup.count_bases(bases, Counting(min_bq=20, min_mq=60, min_dp=5, min_cc=5))
    assert {(r.pos, r.ref, r.dp, r.nc) for r in counted.collect()} == {(p, seq[p - 1], 6, 6) for p in range(48, 54)}


def test_bases_by_chunk_shuffle_reads_alone(spark, monkeypatch):
    monkeypatch.setattr(alignments, "TASK_BASES", 1000)
    rng = random.Random(8)
    cigars = ["20M", "5S8M2I5M", "6M3D14M", "7M900N13M", "7M40N2I11M", "3H4S10M1P2I4M2P", "20S", "*", None, "4M0D16M", "1M2000N1I1M30N17M"]
    rows = [(k, rng.choice(["chr1", "chr2"]), rng.choice([-3, 0, 1, 7, 48, 50, 51, 399, None]), rng.choice(cigars), "ACGTA" * 4, [rng.randrange(41) for _ in range(20)], rng.random() < 0.5, "c") for k in range(300)]
    df = spark.createDataFrame(rows, READS)
    chunks = spark.createDataFrame([(c, k, "ACGTN" * 12) for c in ("chr1", "chr2") for k in range(0, 40, 2)], "chrom string, chunk long, seq string")
    whole = alignments.read_bases(df)
    for size in (1, 50, 5000):
        dealt = alignments.bases_by_chunk(df, size)
        assert sorted(map(str, dealt.drop("chunk").select(whole.columns).collect())) == sorted(map(str, whole.collect())) and dealt.where(f"chunk <> floor((pos - 1) / {size})").count() == 0
    want, got = alignments.with_reference(whole, chunks, 50), alignments.bases_by_chunk(df, 50, chunks)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and want.where("ref <> 'N'").count()
    counted = dealt.groupBy("chunk", "chrom", "pos", "raw_base").agg(F.count("*"), F.countDistinct("cb"))
    assert counted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert alignments.bases_by_chunk(df.limit(0), 50, chunks).count() == 0


def odd_reads(seed):
    rng = random.Random(seed)
    cigars = ["20M", "5S8M2I5M", "6M3D14M", "7M900N13M", "7M40N2I11M", "3H4S10M1P2I4M2P", "20S", "*", None, "4M0D16M", "1M2000N1I1M30N17M", "25M", "3M2I1D4M", "M5Q4M", "12M0I8M"]
    rows = []
    for k in range(600):
        seq = rng.choice(["ACGTA" * 4, "acgtn" * 4, "ACGRU", "", "*", None, "AC-+" * 5])
        qual = rng.choice([[rng.randrange(41) for _ in range(20)], [30] * 6, [None, 7, 40, None, 39], [], None])
        rows.append((k, rng.choice(["chr1", "chr2", None]), rng.choice([-3, 0, 1, 7, 48, 50, 51, 399, None]), rng.choice(cigars), seq, qual, rng.choice([True, False, None]), rng.choice(["c1-1", "c2-1", "c3", None]), rng.choice(["s", "t", None]), rng.choice(["x", "y", None]), rng.choice([60, 60, 60, 3, None]), rng.random() < 0.1))
    return rows


@pytest.mark.parametrize(("bases", "size"), [(500_000, 50), (7, 50), (60, 1), (60, 5000)])
def test_blocks_count_as_rows_do(spark, monkeypatch, bases, size):
    from cytoflux.operators import read_blocks

    monkeypatch.setattr(read_blocks, "BASES", bases)
    monkeypatch.setattr(read_blocks, "TASK_BASES", 3000)
    df = spark.createDataFrame(odd_reads(size), READS + ", sample_id string, cell_type string, map_qual int, is_secondary boolean").withColumns({c: F.lit(False) for c in ("is_duplicate", "is_supplementary")})
    for reads in (df, df.withColumn("qual", F.array_join(F.transform("qual", lambda q: F.char(q + 33)), ""))):
        want = alignments.read_bases(reads).groupBy("sample_id", "chrom", "pos", "raw_base").agg(F.count("*").alias("n"), F.sum("base_qual").alias("bq"), F.countDistinct("cb").alias("nc"))
        got = read_blocks.count_tokens(reads, size)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count()
    chunks = spark.createDataFrame([(c, k, "ACGTNacgtr"[:: 1 - 2 * (k % 2)] * (size // 10 + 2)) for c in ("chr1", "chr2") for k in range(-4, 3000 // size + 1) if k % 3 != 2], "chrom string, chunk long, seq string")
    bases_ = alignments.with_reference(alignments.read_bases(df), chunks, size)
    for params in (Counting(min_bq=5, min_mq=60, min_dp=1, min_cc=1), Counting(min_bq=0, min_mq=0, min_dp=3, min_cc=2, min_ac=2)):
        want, got = pileup.count_bases(bases_, params), read_blocks.count_pileup(df, size, chunks, params)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())) and want.count()
    assert read_blocks.count_tokens(df.limit(0), size).count() == read_blocks.count_pileup(df.limit(0), size, chunks).count() == 0
