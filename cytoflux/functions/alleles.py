"""Column expressions on pileup tokens, alleles and filter tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed order of the per-allele vectors: insertions and deletions last.
ALLELES = ("A", "C", "T", "G", "I", "D")
BASES = ALLELES[:4]
#: Tags that a mitochondrial site must not have, other tags of a final call, and of a re-annotation variant.
CHRM_DROPS = ("Min_cell_types", "PoN_LR", "gnomAD", "LC_Upstream", "LC_Downstream", "RNA_editing_db")
HCCV_DROPS = ("Noisy_site", "LC_Upstream", "LC_Downstream", "gnomAD", "RNA_editing_db", "PoN_SR", "PoN_LR")
FINAL_DROPS = ("Min_cell_types", "Cell_type_noise", *HCCV_DROPS)


def token_class(token: Column) -> Column:
    """A base (upper-cased), D or I for a base followed by a deletion or insertion, O inside a deletion, NA for the rest."""
    second = F.substring(token, 2, 1)
    base = F.upper(token)
    return (
        F.when((F.length(token) == 1) & base.isin("A", "C", "T", "G", "N"), base)
        .when(second == "-", "D").when(second == "+", "I").when(token == "*", "O").otherwise("NA")
    )


def barcode(cb: Column) -> Column:
    """The barcode without its suffix."""
    return F.substring_index(cb, "-", 1)


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def variant_key(chrom: Column, pos: Column, alt: Column) -> Column:
    """chrom:pos:first alternative allele."""
    return F.concat_ws(":", chrom, pos.cast("string"), F.element_at(F.split(alt, ","), 1))


def fraction(part: Column, whole: Column) -> Column:
    return F.round(part / F.nullif(whole, F.lit(0)), 4)


def at(vector: Column, allele: Column) -> Column:
    """An allele's entry of a vector in the order of ALLELES."""
    return F.element_at(vector, F.array_position(F.array(*map(F.lit, ALLELES)), allele).cast("int"))


def long_run(context: Column) -> Column:
    """Whether one base stands four times or more in a row."""
    return F.rlike(context, F.lit("AAAA|CCCC|GGGG|TTTT|NNNN"))


def tags(*conditions: tuple[Column, str]) -> Column:
    """The names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for c, name in conditions]))


def any_tag(filters: Column, names: tuple[str, ...]) -> Column:
    return F.arrays_overlap(filters, F.array(*map(F.lit, names)))


def without_tag(filters: Column, name: str) -> Column:
    return F.array_remove(filters, name)


def shown(filters: Column) -> Column:
    """PASS for no tags, `.` for null."""
    return F.when(filters.isNull(), ".").when(F.size(filters) == 0, "PASS").otherwise(F.array_join(filters, ","))


def clip_trim(qualities: Column, trim: int, left_clip: Column, right_clip: Column) -> Column:
    """Qualities with the first and last `trim` unclipped ones set to 0; a soft clip of 20 to 29 counts as 30."""
    if not trim:
        return qualities
    ends = [F.when(c.between(20, 29), 30).otherwise(F.coalesce(c, F.lit(0))) + trim for c in (left_clip, right_clip)]
    return F.transform(qualities, lambda q, i: F.when((i < ends[0]) | (i >= F.size(qualities) - ends[1]), 0).otherwise(q))


def running_name(name: Column, number: Column, total: Column) -> Column:
    """The name with its number where it occurs more than once."""
    return F.when(total > 1, F.concat(name, number.cast("string"))).otherwise(name)
