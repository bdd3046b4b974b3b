"""The corpus pipeline: language ID, near duplicates, benchmark passages, secrets, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cytoflux.llm import decontam, langid, mixing, near_dup, secrets
from cytoflux.llm.common import cut, fresh, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language's centroids are near to; a null, empty or letterless text is one.

    Learns from this stage's own input, as op8 does. Repeated rows share a fate; very long texts count whole; an
    empty table gives no rows. All columns stay as they are.
    """
    (language,) = fresh(docs, "language")
    return langid.identify(docs, langid.train(docs), language).where(~F.col(f"{language}.rejected")).drop(language)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: the one with the least id that is not null, then with the least MD5 of its text.

    Rows, not ids, are chosen: of repeated rows (same id and text) one stays, the one whose columns are least; of
    different texts under one id each is judged by itself, so both stay if they belong to different groups. A null or
    empty text, or one without a word, is in no group; of such rows every one stays. Very long texts are compared on
    all their words. An empty table gives no rows.
    """
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words 5 % or more lie in windows of benchmark items; see `decontam.clean`."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets; every document stays, with n_chars brought up to date; see `secrets.redact`."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: the columns of documents, and how many copies go in; see `mixing.mix_documents`."""
    return mixing.mix_documents(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secret_scan", secret_scan), ("mixing", mix)]
#: A trained model and similarity classes have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
