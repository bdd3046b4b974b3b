"""Aligned reads to read bases: a fold over the operations of each CIGAR gives every covered place its pileup token.

All of it are expressions on the row of a read, so that nothing is shuffled: operations are placed on the reference and
on the read by running sums, each becomes one segment with its own bases and qualities, and segments are exploded into places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATION = r"(\d+)([MIDNSHP=X])"
ON_REFERENCE, ON_READ, MATCHES = ("M", "D", "N", "=", "X"), ("M", "I", "S", "=", "X"), ("M", "=", "X")
#: Operations that are folded at a time. A fold copies what it has so far, so that blocks keep the cost of long CIGARs linear.
BLOCK = 128
#: Bases of the reads that one task turns into read bases.
TASK_BASES = 500_000
PLACED = "array<struct<op:string,n:int,at:int,from:int>>"


def operations(cigar: Column) -> Column:
    """Array of (n, op), without hard clips and padding; none for null and `*`."""
    number, letter = (F.regexp_extract_all(F.coalesce(cigar, F.lit("")), F.lit(OPERATION), F.lit(k)) for k in (1, 2))
    pairs = F.zip_with(number, letter, lambda n, op: F.struct(n.cast("int").alias("n"), op.alias("op")))
    return F.filter(pairs, lambda x: ~x["op"].isin("H", "P"))


def _advance(x: Column, kinds: tuple[str, ...]) -> Column:
    return F.when(x["op"].isin(*kinds), x["n"]).otherwise(0)


def _total(ops: Column, kinds: tuple[str, ...]) -> Column:
    return F.aggregate(ops, F.lit(0), lambda t, x: t + _advance(x, kinds))


def _running(items: Column, start: Column, step, item) -> Column:
    """The items, each with the sums of the steps before it: a fold whose state is (at, from, items so far)."""
    fold = lambda t, x: F.struct((t["at"] + step(x)[0]).alias("at"), (t["from"] + step(x)[1]).alias("from"), F.concat(t["out"], F.array(item(t, x))).alias("out"))
    return F.aggregate(items, start, fold)["out"]


def place(ops: Column, block: int = BLOCK) -> Column:
    """Array of (op, n, at, from): how many reference bases and how many read bases lie before each operation."""
    begin = lambda at, from_, kind: F.struct(at.alias("at"), from_.alias("from"), F.array().cast(kind).alias("out"))
    zero = F.lit(0)
    blocks = F.when(F.size(ops) > 0, F.transform(F.sequence(zero, F.floor((F.size(ops) - 1) / block).cast("int")), lambda b: F.slice(ops, b * block + 1, F.lit(block))))
    totals = F.transform(blocks, lambda b: F.struct(_total(b, ON_REFERENCE).alias("at"), _total(b, ON_READ).alias("from")))
    starts = _running(totals, begin(zero, zero, "array<struct<at:int,from:int>>"), lambda x: (x["at"], x["from"]), lambda t, _: F.struct(t["at"].alias("at"), t["from"].alias("from")))
    within = lambda b, s: _running(
        b, begin(s["at"], s["from"], PLACED), lambda x: (_advance(x, ON_REFERENCE), _advance(x, ON_READ)),
        lambda t, x: F.struct(x["op"].alias("op"), x["n"].alias("n"), t["at"].alias("at"), t["from"].alias("from")),
    )
    return F.coalesce(F.flatten(F.zip_with(blocks, starts, within)), F.array().cast(PLACED))


def qualities(qual: Column, phred_text: bool) -> Column:
    """Array of qualities; phred_text: the column is text with an offset of 33."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - 33) if phred_text else qual


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is generated, so that Spark computes it once a row and copies it into no other expression."""
    return df.withColumn(name, F.explode(F.array(value)))


def read_bases(reads: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per read and covered reference place: the columns of reads but cigar, seq and qual, with pos moved to the
    place, and raw_base and base_qual.

    reads: pos (of the first aligned base), cigar, seq, qual (array of numbers, or text with an offset of 33), is_reverse, and any others. Tokens are
    as a pileup has them: the base, `*` inside a deletion; behind the last place of an operation `+nSEQ` for an
    insertion that follows and `-nNNN` for a deletion; lower-case on the reverse strand. A place inside a deletion has the
    quality of the read's next base. Skipped places (introns) give no row, but for the last one before an insertion (`>` or `<`).

    Clips and padding cover nothing; insertions that padding parts are two, and the first one shows. Reads without
    CIGAR, sequence (null or `*`) or place give no row; a missing quality is null.
    """
    reads = reads.where(F.col("pos").isNotNull() & F.col("cigar").isNotNull() & F.col("seq").isNotNull() & (F.col("seq") != "*"))
    kept = [F.col(f"`{c}`") for c in reads.columns if c not in ("cigar", "seq", "qual")]
    phred_text = dict(reads.dtypes)["qual"] == "string"
    placed = once(once(reads, "_listed", operations(F.col("cigar"))), "_ops", place(F.col("_listed"), block))
    prepared = once(once(placed, "_bases", F.split("seq", "")), "_quals", qualities(F.col("qual"), phred_text)).select(*kept, "_ops", "_bases", "_quals")
    following = F.slice("_ops", F.lit(2), F.greatest(F.size("_ops") - 1, F.lit(0)))
    pairs = F.filter(F.zip_with("_ops", following, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), lambda p: p["x"]["op"].isin("D", *MATCHES) | ((p["x"]["op"] == "N") & (p["y"]["op"] == "I")))
    part = lambda values, x: F.slice(values, x["from"] + 1, F.when(x["op"].isin(*MATCHES), x["n"]).otherwise(1))

    def segment(p: Column) -> Column:
        x, y = p["x"], p["y"]
        inserted = F.concat(F.lit("+"), y["n"].cast("string"), F.array_join(F.slice("_bases", y["from"] + 1, y["n"]), ""))
        deleted = F.concat(F.lit("-"), y["n"].cast("string"), F.repeat(F.lit("N"), y["n"]))
        behind = F.when(y["op"] == "I", inserted).when((y["op"] == "D") & (x["op"] != "D"), deleted).otherwise("")
        return F.struct(x["op"].alias("op"), x["n"].alias("n"), x["at"].alias("at"), part(F.col("_bases"), x).alias("bases"), part(F.col("_quals"), x).alias("quals"), behind.alias("behind"))

    segments = once(once(prepared, "_pairs", pairs), "_segments", F.transform("_pairs", segment)).select(*kept, F.explode("_segments").alias("_s"))
    places = segments.select(*kept, "_s", F.explode(F.sequence(F.when(F.col("_s.op") == "N", F.col("_s.n") - 1).otherwise(0), F.col("_s.n") - 1)).alias("_o"))
    matched = F.col("_s.op").isin(*MATCHES)
    base = F.when(matched, F.get("_s.bases", F.col("_o"))).when(F.col("_s.op") == "D", "*").otherwise(F.when(F.col("is_reverse"), "<").otherwise(">"))
    token = F.concat(base, F.when(F.col("_o") == F.col("_s.n") - 1, F.col("_s.behind")).otherwise(""))
    others = [F.col(f"`{c}`") for c in reads.columns if c not in ("cigar", "seq", "qual", "pos")]
    return places.where(F.col("_s.n") > 0).select(
        *others, (F.col("pos") + F.col("_s.at") + F.col("_o")).alias("pos"), F.when(F.col("is_reverse"), F.lower(token)).otherwise(F.upper(token)).alias("raw_base"),
        F.get("_s.quals", F.when(matched, F.col("_o")).otherwise(0)).cast("int").alias("base_qual"),
    )


def with_reference(bases: DataFrame, chunks: DataFrame, size: int, flank: int = 5) -> DataFrame:
    """bases plus ref, the upper-case reference base (N where the reference has none). chunks: see `reference_context`."""
    joined = bases.withColumn("chunk", F.floor((F.col("pos") - 1) / size)).join(chunks.select("chrom", "chunk", "seq"), ["chrom", "chunk"], "left")
    return _referred(joined, "seq", size, flank).drop("chunk", "seq")


def _referred(bases: DataFrame, seq: str, size: int, flank: int) -> DataFrame:
    before = F.when(F.col("chunk") > 0, flank).otherwise(0)
    base = F.upper(F.substring(seq, (F.col("pos") - F.col("chunk") * size + before).cast("int"), F.lit(1)))
    return bases.withColumn("ref", F.when(base != "", base).otherwise("N"))


def dealt_by_chunk(reads: DataFrame, size: int, tasks: int) -> DataFrame:
    """reads with chunk, a row for each chunk of `size` places that they cover, dealt to tasks by (chrom, chunk).

    A read is smaller than its read bases, so that reads are shuffled, once, and what groups read bases by chunk and place needs no
    other shuffle. chunk: floor((pos - 1) / size), as in `with_reference`.
    """
    chunk = lambda at: F.floor((F.col("pos") + at - 1) / size)
    last = lambda x: x["at"] + x["n"] - 1
    # An intron gives no place, but for its last one before an insertion.
    placed = once(once(reads, "_listed", operations(F.col("cigar"))), "_ops", place(F.col("_listed")))
    covering = F.filter("_ops", lambda x: (x["n"] > 0) & x["op"].isin("D", "N", *MATCHES))
    touched = F.transform(covering, lambda x: F.sequence(F.when(x["op"] == "N", chunk(last(x))).otherwise(chunk(x["at"])), chunk(last(x))))
    chunks = once(placed, "_chunks", F.array_distinct(F.flatten(touched))).select(*reads.columns, F.explode("_chunks").alias("chunk"))
    return chunks.repartition(tasks, "chrom", "chunk")


def bases_by_chunk(reads: DataFrame, size: int, chunks: DataFrame | None = None, flank: int = 5) -> DataFrame:
    """`read_bases` plus chunk, dealt by (chrom, chunk); with chunks also ref, as from `with_reference`: reads meet their chunk before they become bases.

    There are as many tasks as the reads' bases ask for. All reads of a chunk meet in one task.
    """
    tasks = max(1, -(-(reads.agg(F.sum(F.length("seq"))).first()[0] or 0) // TASK_BASES))
    dealt = dealt_by_chunk(reads, size, tasks)
    if chunks is not None:
        own = chunks.select("chrom", "chunk", F.col("seq").alias("ref_seq_"))
        dealt = dealt.join(own.repartition(tasks, "chrom", "chunk").hint("merge"), ["chrom", "chunk"], "left")
    bases = read_bases(dealt).where(F.floor((F.col("pos") - 1) / size) == F.col("chunk"))
    return bases if chunks is None else _referred(bases, "ref_seq_", size, flank).drop("ref_seq_")
