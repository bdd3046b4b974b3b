"""Single-cell tables made from the synthetic star schema, by integer arithmetic and substrings alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 500
PATTERN = "ACTGAAAATTTCGGGCCCCATTTGACT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chrom(key: str) -> Column:
    return F.when(F.col(key) % 50 == 0, "chrM").otherwise(F.concat(F.lit("chr"), (F.col(key) % 22 + 1).cast("string")))


def pos(key: str) -> Column:
    return (F.col(key) * 7 + F.col(key) % 13 * 40).cast("long")


def letter(letters: str, number: Column) -> Column:
    return F.substring(F.lit(letters), (number + 1).cast("int"), F.lit(1))


def cell_type(key: str) -> Column:
    return F.when(F.col(key) % 2 == 0, "Cancer").otherwise("Non-Cancer")


def read_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per read and position, with raw tokens as a pileup has them."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    ref = letter("ACTG", F.col("l_partkey") % 4)
    number = F.col("l_orderkey") + F.col("l_linenumber")
    planted = F.when((F.col("l_suppkey") % 2 == 0) & (number % 3 != 0), letter("CTGA", F.col("l_partkey") % 4)).otherwise(ref)
    base = F.when(F.col("l_partkey") % 5 == 0, planted).when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 10 < 8, ref).otherwise(letter("ACTGID", number % 6))
    reverse = F.col("l_linestatus") == "F"
    # Generated, so that Spark computes each of them once and doesn't copy them into every condition on the token.
    li = li.withColumn("base", F.explode(F.array(base)))
    token = F.when(F.col("base") == "I", F.concat(ref, F.lit("+2AT"))).when(F.col("base") == "D", F.concat(ref, F.lit("-1G"))).when(reverse, F.lower("base")).otherwise(F.col("base"))
    li = li.withColumn("token", F.explode(F.array(token)))
    no = F.lit(False)
    return li.select(
        F.col("l_returnflag").alias("sample_id"), chrom("l_partkey").alias("chrom"), pos("l_partkey").alias("pos"), ref.alias("ref"), F.col("token").alias("raw_base"), F.col("l_quantity").cast("int").alias("base_qual"), F.lit(60).alias("map_qual"),
        F.concat(F.lit("CB"), F.col("l_suppkey").cast("string"), F.lit("-1")).alias("cb"), cell_type("l_suppkey").alias("cell_type"), reverse.alias("is_reverse"), no.alias("is_secondary"), no.alias("is_duplicate"), no.alias("is_supplementary"),
    )


#: CIGARs of reads of 20 bases; {} is the length of an intron.
CIGARS = ("20M", "5S8M2I5M", "6M3D14M", "7M{}N13M", "3H4S10M1P2I4M2P", "9=1X5M1D2I3M", "7M{}N2I11M")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aligned read per line item: CIGARs of all operations, bases from PATTERN, qualities as numbers."""
    li = table(spark, sf_dir, "lineitem")
    number = F.col("l_orderkey") + F.col("l_linenumber")
    cigar = F.get(F.array(*map(F.lit, CIGARS)), (number % len(CIGARS)).cast("int"))
    no = F.lit(False)
    return li.select(
        F.col("l_returnflag").alias("sample_id"), chrom("l_partkey").alias("chrom"), (pos("l_partkey") + F.col("l_orderkey") % 3).alias("pos"), F.replace(cigar, F.lit("{}"), (F.col("l_orderkey") % 50 + 20).cast("string")).alias("cigar"),
        F.substring(F.lit(PATTERN * 2), (F.col("l_orderkey") % len(PATTERN) + 1).cast("int"), F.lit(20)).alias("seq"), F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: ((F.col("l_quantity").cast("int") + i * 7) % 41)).alias("qual"), F.lit(60).alias("map_qual"),
        F.concat(F.lit("CB"), F.col("l_suppkey").cast("string"), F.lit("-1")).alias("cb"), cell_type("l_suppkey").alias("cell_type"), (F.col("l_linestatus") == "F").alias("is_reverse"), no.alias("is_secondary"), no.alias("is_duplicate"), no.alias("is_supplementary"),
    )


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned reads with tags, one per line item; every 11th has no barcode, every 13th supplier is not annotated."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("_", F.lit("m"), F.concat(F.col("l_partkey").cast("string"), F.lit("AAA")), F.concat(F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))).alias("name"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 11 != 0, F.concat(F.lit("CB"), F.col("l_suppkey").cast("string"), F.lit("-1"))).alias("cb"),
        (F.col("l_orderkey") % 7).alias("nm"), (F.col("l_partkey") % 3 + 1).alias("nh"), (F.col("l_quantity").cast("int") * 5 + 20).alias("mapq"),
    )


def barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("CB"), F.col("s_suppkey").cast("string")).alias("cb"), cell_type("s_suppkey").alias("cell_type"))


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chrom, pos and the five bases on both sides."""
    side = lambda letters, n, m: F.substring(F.lit(letters), (F.col("p_partkey") % m + 1).cast("int"), F.lit(n))
    return table(spark, sf_dir, "part").select(chrom("p_partkey").alias("chrom"), pos("p_partkey").alias("pos"), side(PATTERN, 5, 22).alias("up"), side(PATTERN[::-1], 5, 22).alias("down"))


def reference_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeating reference in chunks of CHUNK bases with five more at either end."""
    last = table(spark, sf_dir, "part").agg(F.max(pos("p_partkey"))).first()[0] // CHUNK
    whole = F.repeat(F.lit(PATTERN), F.lit(CHUNK // len(PATTERN) + 3))
    at = lambda b: F.pmod(b, F.lit(len(PATTERN)))
    begin = F.when(F.col("chunk") > 0, F.col("chunk") * CHUNK - 5).otherwise(F.col("chunk") * CHUNK)
    sized = F.when(F.col("chunk") > 0, CHUNK + 10).otherwise(CHUNK + 5)
    chroms = table(spark, sf_dir, "part").select(chrom("p_partkey").alias("chrom")).distinct()
    chunks = chroms.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))
    return chunks.select("chrom", "chunk", F.substring(whole, (at(begin) + 1).cast("int"), sized).alias("seq"))


def sites_where(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(condition).select(chrom("p_partkey").alias("chrom"), pos("p_partkey").alias("pos"))


def population_af(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_partkey % 4 = 0")
    return part.select(chrom("p_partkey").alias("chrom"), pos("p_partkey").alias("pos"), letter("ACTG", F.col("p_partkey") % 4).alias("ref"), letter("CTGA", F.col("p_partkey") % 4).alias("alt"), ((F.col("p_partkey") % 200) / 10000.0).alias("af"))


def fusion_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per fusion name and event hour, with its reads as a comma list."""
    ev = table(spark, sf_dir, "events")
    acc = F.concat_ws("^", F.concat(F.lit("CB"), (F.col("user_id") % 20).cast("string")), F.concat(F.lit("U"), (F.col("event_id") % 97).cast("string")), F.concat(F.lit("r"), F.col("event_id").cast("string")))
    name, part = F.concat(F.col("event_type"), F.lit("--g"), (F.col("event_id") % 40).cast("string"), F.lit("x")), F.col("event_id") % 3
    grouped = ev.groupBy(name.alias("fusion"), part.alias("part")).agg(F.array_join(F.sort_array(F.collect_list(acc)), ",").alias("LR_accessions"), F.min("event_id").alias("ordinal"))
    return grouped.withColumn("SpliceType", F.when(F.col("part") == 2, "INCL_NON_REF_SPLICE").otherwise("ONLY_REF_SPLICE")).drop("part")


def fusion_barcodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of the events' users, one row each."""
    cells = table(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("id")).distinct()
    return cells.select(F.concat(F.lit("CB"), F.col("id").cast("string")).alias("cb"), cell_type("id").alias("cell_type"))


def intervals(spark: SparkSession, sf_dir: str, length: str) -> DataFrame:
    """chrom, start, end: one interval for each part."""
    part = table(spark, sf_dir, "part")
    return part.select(chrom("p_partkey").alias("chrom"), pos("p_partkey").alias("start"), (pos("p_partkey") + F.expr(length)).alias("end"))


def cell_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell, mut, value, label: signs of the embeddings; every 17th value is unknown."""
    long = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("mut", "x"))
    value = F.when((F.col("vec_id") + F.col("mut")) % 17 != 0, (F.col("x") > 0).cast("int"))
    return long.select(F.col("vec_id").alias("cell"), F.col("mut").cast("long").alias("mut"), value.alias("value"), F.col("label").cast("long").alias("label"))


def pseudo_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chain, step, ll, lpost from events: four chains in order of the event."""
    ev = table(spark, sf_dir, "events")
    return ev.select((F.col("user_id") % 4).alias("chain"), "event_id", F.round("value", 3).alias("ll"), F.round(F.col("value") + F.col("event_id") % 7, 3).alias("lpost"))
