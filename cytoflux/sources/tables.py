"""Text tables of the workflow: the only place that knows packed columns and missing markers.

Readers take any path that Spark reads and have fixed or header-derived schemas; nothing is inferred.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cytoflux.functions.alleles import shown

KINDS = ("cc", "bc", "bq", "bcf", "bcr")
#: Per allele of a call: its column in the site table, and its type.
ALLELE_FIELDS = {"bc": ("Bc", "long"), "cc": ("Cc", "long"), "vaf": ("VAF", "double"), "mcf": ("MCF", "double"), "p_bc": ("BCp", "double"), "p_cc": ("CCp", "double")}


def read_table(spark: SparkSession, path: str | list[str], schema: str | None = None, header: bool = True, missing: str | None = None) -> DataFrame:
    """A tab-separated table; lines that begin with `##` are comments, and so is a leading `#` of the header."""
    reader = spark.read.option("sep", "\t").option("quote", "")
    if missing is not None:
        reader = reader.option("nullValue", missing)
    if schema is not None:
        return reader.schema(schema).option("comment", "#").csv(path)
    lines = spark.read.text(path).where(~F.startswith("value", F.lit("##")))
    names = lines.first()[0].lstrip("#").split("\t") if header else None
    if not names:
        raise ValueError(f"{path} has no header")
    body = reader.schema(", ".join(f"`{n}` string" for n in names)).option("comment", "#").csv(path)
    return body.where(~F.col(f"`{names[0]}`").eqNullSafe(F.lit(names[0])))


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found)
    return files is not None and len(files) > 0


def read_files(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Several tables with the path each row came from; missing files are skipped, and if all are the result is empty."""
    there = [p for p in paths if _exists(spark, p)]
    if not there:
        return spark.createDataFrame([], f"{schema}, path string")
    return spark.read.option("sep", "\t").option("comment", "#").schema(schema).csv(there).withColumn("path", F.input_file_name())


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """Distinct chrom, pos of a list of sites, gzip or not."""
    return read_table(spark, path, "chrom string, pos long").distinct()


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """ensg and gene of the gene rows of an annotation file."""
    rows = read_table(spark, path, "chrom string, origin string, kind string, start long, end long, score string, strand string, frame string, info string")
    of = lambda key: F.regexp_extract("info", key + r' "([^"]*)"', 1)
    return rows.where("kind = 'gene'").select(of("gene_id").alias("ensg"), of("gene_name").alias("gene"))


def read_gene_counts(spark: SparkSession, path: str) -> DataFrame:
    """ensg, cb, n of a table with one column per cell behind six of annotation; cells are named by their files."""
    df = read_table(spark, path)
    cells = df.columns[6:]
    name = lambda c: c.rsplit("/", 1)[-1].split(".", 1)[0]
    entries = F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(name(c)), F.col(f"`{c}`").cast("long")) for c in cells])))
    return df.select(F.col(df.columns[0]).alias("ensg"), entries.alias("cb", "n"))


def read_matrix(spark: SparkSession, path: str, missing: tuple[str, ...] = ("3", ".", ""), two_is_one: bool = True) -> DataFrame:
    """key, cb, value of a matrix with keys in the first column; `missing` markers are null, 2 counts as 1."""
    df = read_table(spark, path)
    key, cells = df.columns[0], df.columns[1:]
    value = lambda c: F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`").cast("double"))
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("cb"), value(c).alias("value")) for c in cells]))
    out = df.select(F.col(f"`{key}`").alias("key"), entries.alias("e")).select("key", "e.cb", "e.value")
    return out.withColumn("value", F.when(F.col("value") == 2, 1.0).otherwise(F.col("value"))) if two_is_one else out


def _numbered(lines: DataFrame) -> DataFrame:
    """lines of one file plus place: 0, 1, ... in the order of the file. Only the number of lines of each split is gathered."""
    split = lines.withColumn("_id", F.monotonically_increasing_id()).withColumns({"_part": F.shiftright("_id", 33), "_nth": F.col("_id").bitwiseAND((1 << 33) - 1)})
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = split.groupBy("_part").agg(F.count("*").alias("n")).select("_part", before.alias("_before"))
    return split.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_before") + F.col("_nth")).drop("_id", "_part", "_nth", "_before")


def read_any_matrix(spark: SparkSession, path: str) -> DataFrame:
    """key, cb, value of a matrix file of 0 to 3 whose separator, header and row names are told from its first five lines.

    Tabs, commas or blanks part the entries. A first line with anything but 0 to 3 in it is a header (so that row names
    need one), and a first column with anything else below it holds names; rows and columns without names are numbered
    from 0. 3, `.` and blank are null, 2 counts as 1. The path is one file.
    """
    top = [r.value for r in spark.read.text(path).where("value <> ''").head(5)]
    if not top:
        return spark.createDataFrame([], "key string, cb string, value double")
    n = {c: top[0].count(c) for c in "\t, "}
    sep = "\t" if n["\t"] > max(n[" "], n[","]) else "," if n[","] > n[" "] else " "
    known = lambda x: x == " " or bool(re.fullmatch(r"\s*[0-3](\.0*)?\s*", x))
    header = not all(map(known, top[0].split(sep)))
    named = not all(known(line.split(sep)[0]) for line in top[header:])
    width = len(top[-1].split(sep)) - named
    parts = F.split("value", re.escape(sep))
    key = F.get(parts, 0) if named else (F.col("place") - int(header)).cast("string")
    rows = _numbered(spark.read.text(path).where("value <> ''")).where(F.col("place") >= int(header))
    out = rows.select(key.alias("key"), F.posexplode(F.slice(parts, 1 + named, width)).alias("nth", "raw"))
    names = F.array(*[F.lit(x.strip()) for x in top[0].split(sep)[-width:]])
    value = F.trim("raw").try_cast("double")
    return out.select("key", (F.get(names, "nth") if header else F.col("nth").cast("string")).alias("cb"), F.when(value == 2, 1.0).when(value != 3, value).alias("value"))


def read_parameters(spark: SparkSession, path: str) -> dict[str, float]:
    """The one row of a parameter file (alpha1 and beta1 of reads, alpha2 and beta2 of cells) by name."""
    return {k: float(v) for k, v in read_table(spark, path).first().asDict().items()}


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """The sample map, with the sample in `sample_id`."""
    return read_table(spark, path).withColumnRenamed("sample", "sample_id")


def read_fusions(spark: SparkSession, path: str) -> DataFrame:
    """Fusion predictions as `filter_fusions` takes them: the name is in `fusion`, and `ordinal` orders rows as the files do."""
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("id"))
    return read_table(spark, path).withColumn("ordinal", place).withColumnRenamed("FusionName", "fusion")


def transposed(long: DataFrame) -> DataFrame:
    return long.select(F.col("cb").alias("key"), F.col("key").alias("cb"), "value")


def read_assignment(spark: SparkSession, path: str) -> DataFrame:
    """place, cluster of blank-separated numbers on one line."""
    return spark.read.text(path).where("trim(value) <> ''").select(F.posexplode(F.split(F.trim("value"), r"\s+")).alias("place", "cluster")).withColumn("cluster", F.col("cluster").cast("int"))


def pack(counts: DataFrame) -> DataFrame:
    """chrom, pos, ref, cell_type, info: dp|nc|cc|bc|bq|bcf|bcr with entries in the order of ALLELES joined by `:`."""
    joined = [F.array_join(F.col(k).cast("array<string>"), ":") for k in KINDS]
    return counts.select("chrom", "pos", "ref", "cell_type", F.concat_ws("|", F.col("dp").cast("string"), F.col("nc").cast("string"), *joined).alias("info"))


def unpack(packed: DataFrame) -> DataFrame:
    """What `pack` packed; rows of NA have no counts and are dropped."""
    parts = F.split("info", r"\|")
    vectors = {k: F.split(parts[i + 2], ":").cast("array<bigint>") for i, k in enumerate(KINDS)}
    return packed.where(~F.startswith("info", F.lit("NA"))).withColumns({"dp": parts[0].cast("long"), "nc": parts[1].cast("long")} | vectors).drop("info")


def merged_wide(counts: DataFrame, cell_types: list[str]) -> DataFrame:
    """One row a site, one packed column a cell type, NA where it has none."""
    wide = pack(counts).groupBy("chrom", "pos").pivot("cell_type", cell_types).agg(F.first("info"))
    refs = counts.groupBy("chrom", "pos").agg(F.min("ref").alias("ref"))
    return refs.join(wide, ["chrom", "pos"]).select("chrom", F.col("pos").alias("Start"), F.col("pos").alias("End"), "ref", *[F.coalesce(f"`{c}`", F.lit("NA")).alias(c) for c in cell_types])


def call_columns(calls: DataFrame, cell_types: list[str] | None = None) -> DataFrame:
    """The site table as text: cell types joined by `,` and their alleles by `|`; `.` for none.

    cell_types: those whose counts follow, packed, in columns of their own, so that `read_calls` can give them back.
    """
    of = lambda f: F.array_join(F.transform("calls", f), ",")
    inner = lambda name: of(lambda c: F.array_join(F.transform(c["alts"], lambda a: a[name].cast("string")), "|"))
    dot = lambda x: F.when(F.size("calls") > 0, x).otherwise(".")
    triple = lambda a, b, p: F.concat_ws(";", F.col(a).cast("string"), F.col(b).cast("string"), F.col(p).cast("string"))
    named = {"ALT": inner("alt"), "Cell_types": of(lambda c: c["cell_type"]), "Dp": of(lambda c: c["dp"].cast("string")), "Nc": of(lambda c: c["nc"].cast("string")), "Bc": inner("bc"), "Cc": inner("cc"), "VAF": inner("vaf"), "MCF": inner("mcf"), "BCp": inner("p_bc"), "CCp": inner("p_cc"), "Cell_type_Filter": of(lambda c: c["filter"])}
    cols = {k: dot(v) for k, v in named.items()}
    own = lambda t: F.get(F.filter("counts", lambda c: c["cell_type"] == t), 0)
    joined = lambda c, k: F.array_join(c[k].cast("array<string>"), ":")
    packed = lambda c: F.when(c.isNull(), "NA").otherwise(F.concat_ws("|", c["dp"].cast("string"), c["nc"].cast("string"), joined(c, "cc"), joined(c, "bc")))
    counted = [F.lit("DP|NC|CC|BC").alias("INFO"), *[packed(own(t)).alias(t) for t in cell_types]] if cell_types else []
    return calls.select(
        F.col("chrom").alias("#CHROM"), F.col("pos").alias("Start"), F.col("pos").alias("End"), F.col("ref").alias("REF"), cols["ALT"].alias("ALT"), shown(F.col("filters")).alias("FILTER"), cols["Cell_types"].alias("Cell_types"),
        F.col("up").alias("Up_context"), F.col("down").alias("Down_context"), dot(F.col("n_alts").cast("string")).alias("N_ALT"), *[cols[k].alias(k) for k in ("Dp", "Nc", "Bc", "Cc", "VAF", "MCF", "BCp", "CCp")],
        F.col("n_callable").alias("Cell_types_min_BC"), F.col("n_callable").alias("Cell_types_min_CC"), triple("rest_bc", "rest_dp", "p_noise_bc").alias("Rest_BC"), triple("rest_cc", "rest_nc", "p_noise_cc").alias("Rest_CC"), cols["Cell_type_Filter"].alias("Cell_type_Filter"), *counted,
    )


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """A site table back as `call_sites` or `annotate_filters` gave it, so that the next step starts from the file.

    `counts` comes from the columns of cell types behind INFO (their first four entries); it is empty without them.
    """
    df = read_table(spark, path)
    nth = lambda name, i: F.get(F.split(name, ","), i)

    def call(cell_type: Column, i: Column) -> Column:
        of = lambda name, j: F.get(F.split(nth(name, i), r"\|"), j)
        allele = lambda a, j: F.struct(a.alias("alt"), *[of(name, j).try_cast(kind).alias(k) for k, (name, kind) in ALLELE_FIELDS.items()])
        alts = F.transform(F.split(nth("ALT", i), r"\|"), allele)
        return F.struct(cell_type.alias("cell_type"), nth("Dp", i).try_cast("long").alias("dp"), nth("Nc", i).try_cast("long").alias("nc"), alts.alias("alts"), nth("Cell_type_Filter", i).alias("filter"))

    def counts(name: str) -> Column:
        part = F.split(f"`{name}`", r"\|")
        vector = lambda k: F.transform(F.split(F.get(part, k), ":"), lambda x: x.try_cast("long"))
        return F.when(~F.startswith(F.col(f"`{name}`"), F.lit("NA")), F.struct(F.lit(name).alias("cell_type"), F.get(part, 0).try_cast("long").alias("dp"), F.get(part, 1).try_cast("long").alias("nc"), vector(3).alias("bc"), vector(2).alias("cc")))

    cell_types = sorted(df.columns[df.columns.index("INFO") + 1 :]) if "INFO" in df.columns else []
    counted = F.array_compact(F.array(*map(counts, cell_types))) if cell_types else F.array().cast("array<struct<cell_type:string,dp:bigint,nc:bigint,bc:array<bigint>,cc:array<bigint>>>")
    rest = lambda name, i, kind: F.get(F.split(name, ";"), i).try_cast(kind)
    filters = F.when(F.col("FILTER") == "PASS", F.array().cast("array<string>")).when(F.col("FILTER") != ".", F.split("FILTER", ","))
    return df.select(
        F.col("CHROM").alias("chrom"), F.col("Start").try_cast("long").alias("pos"), F.col("REF").alias("ref"), F.col("Cell_types_min_BC").try_cast("long").alias("n_callable"),
        *[rest(f"Rest_{k.upper()}", i, kind).alias(name) for k, n in (("bc", "dp"), ("cc", "nc")) for i, (name, kind) in enumerate([(f"rest_{k}", "long"), (f"rest_{n}", "long"), (f"p_noise_{k}", "double")])],
        F.transform(F.filter(F.split("Cell_types", ","), lambda x: x != "."), call).alias("calls"), counted.alias("counts"), F.col("Up_context").alias("up"), F.col("Down_context").alias("down"),
        F.coalesce(F.col("N_ALT").try_cast("int"), F.lit(0)).alias("n_alts"), filters.alias("filters"),
    )


def write_table(df: DataFrame, path: str, order: list[Column | str] | None = None, partition_by: list[str] | None = None, missing: str = "") -> None:
    """A folder of tab-separated parts with headers; ordered over all parts if asked for, or split by columns."""
    out = df.orderBy(*order) if order else df
    writer = out.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", missing).option("emptyValue", "")
    writer = writer.option("comment", "\x01").option("escapeQuotes", False)  # else names that begin with # stand in quotes
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_reads(reads: DataFrame, path: str, by: str = "cell_type") -> None:
    """Parquet, a folder for each cell type (or barcode)."""
    reads.repartition(by, F.pmod(F.xxhash64("name"), F.lit(16))).write.mode("overwrite").partitionBy(by).parquet(path)


