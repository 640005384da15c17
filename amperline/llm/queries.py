"""The corpus queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amperline.llm import decontamination, html_consensus, manifest, mixing, near_dedup, packing, quality_classifier, quality_rules, revisits, spelling, suffix_dedup, token_counts, toxicity


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.verdicts(_table(spark, folder, "documents")).select(*counts)


def _fold(parts: int, held_out: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts == held_out


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    found = toxicity.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"), _fold(5, 0))
    return found.withColumn("n_passages", F.size("segments")).drop("segments")


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "passage")


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.removal(_table(spark, folder, "documents"))


def op6_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = revisits.resolve(revisits.captures(_table(spark, folder, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e.key, F.lit(": "), e.value))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op7_html_consensus(spark: SparkSession, folder: str) -> DataFrame:
    return html_consensus.extracted(_table(spark, folder, "pages"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.grouped(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, folder, "documents"))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"), _fold(3, 1))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.audited(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_revisits": op6_revisits,
    "op7_html_consensus": op7_html_consensus,
    "op8_near_dedup": op8_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_mixing": op12_mixing,
    "op13_manifest": op13_manifest,
}
