"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.sources.scratch import Scratch, cut, shared_dir

__all__ = ["Scratch", "ascii_lower", "cut", "fresh", "shared_dir", "space_words", "table"]
#: Java regex of the separators between words: space, tab, LF, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Runs of other characters than white space; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many leading underscores as keep it apart from df's columns, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
