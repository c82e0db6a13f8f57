"""The queries of the training-data operators over whole tables, and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stampbook.llm import collocations, decontamination, licences, pieces, quality, reference, scoring, simhash, substring, suffix, tokens, toxicity, whitening, wrappers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _over_documents(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: build(table(spark, folder, "documents"))


_over_documents("op1_lm_scoring", scoring.op1)
_over_documents("op2_simhash_near_dedup", simhash.op2)
_over_documents("op3_suffix_array_dedup", suffix.op3)
_over_documents("op4_substring_dedup", substring.op4)
_over_documents("op5_training_order", tokens.op5)
QUERIES["op6_benchmark_decontamination"] = lambda spark, folder: decontamination.op6(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
_over_documents("op7_sentencepiece", pieces.op7)
QUERIES["op8_html_extraction"] = lambda spark, folder: wrappers.op8(table(spark, folder, "pages"))
_over_documents("op9_quality_rules", quality.op9)
QUERIES["op10_toxicity"] = lambda spark, folder: toxicity.op10(table(spark, folder, "documents"), table(spark, folder, "labels"))
_over_documents("op11_license_scan", licences.op11)
_over_documents("op12_collocations", collocations.op12)
QUERIES["op13_embedding_whitening"] = lambda spark, folder: whitening.op13(table(spark, folder, "embeddings"))

ORACLES["op4_substring_dedup"] = reference.SUBSTRING
ORACLES["op6_benchmark_decontamination"] = reference.OVERLAP
ORACLES["op9_quality_rules"] = reference.QUALITY
ORACLES["op11_license_scan"] = reference.LICENCES
ORACLES["op12_collocations"] = reference.COLLOCATIONS
