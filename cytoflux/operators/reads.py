"""Read admission, reason reports, read text, cell metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoflux.functions.alleles import barcode, clip_trim


def binarize_cell_types(barcodes: DataFrame, cancer_type: str) -> DataFrame:
    """Cell_type becomes Cancer or Non-Cancer; the one before stays as Input_cell_type."""
    return barcodes.withColumn("Input_cell_type", F.col("Cell_type")).withColumn("Cell_type", F.when(F.col("Cell_type") == cancer_type, "Cancer").otherwise("Non-Cancer"))


def clean_metadata(barcodes: DataFrame, tissue: str | None = None) -> DataFrame:
    """Barcodes without suffix, cell types without spaces and with the tissue in front."""
    name = F.replace(F.col("Cell_type"), F.lit(" "), F.lit("_"))
    return barcodes.select(F.regexp_replace("Index", "-.*$", "").alias("cb"), (F.concat(F.lit(f"{tissue}__"), name) if tissue else name).alias("cell_type")).distinct()


def admission(max_nm: int | None, max_nh: int | None, min_mq: int) -> Column:
    """Why a read (cb, cell_type, nm, nh, mapq) is not used, or PASS. A missing tag does not fail its own limit."""
    limits = [F.when(F.col("mapq") < min_mq, "MAPQ")]
    if max_nh is not None:
        limits.insert(0, F.when(F.col("nh") > max_nh, "NH"))
    if max_nm is not None:
        limits.insert(0, F.when(F.col("nm") > max_nm, "nM"))
    reasons = F.concat_ws(";", *limits)
    return F.when(F.col("cb").isNull(), "CB_not_found").when(F.col("cell_type").isNull(), "CB_not_matched").when(reasons != "", reasons).otherwise("PASS")


def admit_reads(reads: DataFrame, metadata: DataFrame, max_nm: int | None = None, max_nh: int | None = None, min_mq: int = 255, n_trim: int = 0) -> DataFrame:
    """reads plus cell_type and reason, qualities trimmed at both ends. metadata (cb, cell_type) has one row a cell."""
    joined = reads.withColumn("cb", barcode(F.col("cb"))).join(metadata, "cb", "left")
    if n_trim:
        joined = joined.withColumn("qual", clip_trim(F.col("qual"), n_trim, F.col("clip_left"), F.col("clip_right")))
    return joined.withColumn("reason", admission(max_nm, max_nh, min_mq))


def admission_report(admitted: DataFrame) -> DataFrame:
    return admitted.groupBy("reason").agg(F.count("*").alias("n_reads"))


def read_key(cb: Column, ub: Column, name: Column) -> Column:
    """barcode^UMI^name; without a UMI tag, the last but one part of the name less its last 3 characters; NA without a barcode."""
    part = F.element_at(F.split(name, "_"), -2)
    umi = F.coalesce(ub, F.substring(part, F.lit(1), F.length(part) - 3))
    return F.concat_ws("^", F.coalesce(barcode(cb), F.lit("NA")), umi, name)


def to_fastq(reads: DataFrame) -> DataFrame:
    """One value of four lines for each read (name, cb, ub, seq, qual as text)."""
    return reads.select(F.concat_ws("\n", F.concat(F.lit("@"), read_key(F.col("cb"), F.col("ub"), F.col("name"))), "seq", F.lit("+"), "qual").alias("value"))
