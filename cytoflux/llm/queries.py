"""The training-data queries, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


from cytoflux.llm import chat, decontam, filter_audit, importance, langid, licences, long_repeats, mixing, near_dup, packing, quality, secrets, url_filter
from cytoflux.llm.common import table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
PLANTED_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, url_filter.rules_frame(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED_TURNS, "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_paths(chat.chain(turns.unionByName(planted))))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"), k=3, percent=85)


def op10_long_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_url_filter, op2_licence_scan, op3_chat_format, op4_mixing, op5_quality_rules, op6_secret_scan, op7_decontaminate, op8_language_id, op9_near_duplicates, op10_long_repeats, op11_importance_resampling, op12_filter_audit, op13_packing)
    return {f.__name__: f for f in named}
