"""The training corpus from the table of documents, in five stages that each take what the one before kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampbook.llm import decontamination, pieces, simhash, substring, toxicity
from stampbook.llm.working import kept


def _whole(docs: DataFrame) -> Column:
    """The input row as one column, whatever its columns are called."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")


# Every stage takes null, empty and very long texts, repeated rows and ids, null ids, an empty table, and further columns
# of any name, which it passes through unchanged. A null or empty text is never toxic by its words (it has the score of a
# text without known words), has no repeated passage or benchmark passage, and no pieces.


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores below one half; repeated rows go or stay together."""
    model = toxicity.fit(toxicity.labelled_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return docs.where(toxicity.scorer(model)(F.col("text")) < 0.5)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest doc_id (and hash of the text, if several have it).

    Rows are told apart by doc_id and text: different texts under one doc_id, or without any, are different
    documents, and a text without a doc_id gives way to its copy that has one. Texts without words are one group.
    """
    first = simhash.first_rows(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_first"), F.col("text_hash").alias("_first_hash"))
    hashed = docs.select(_whole(docs), F.col("doc_id").alias("_own"), simhash.text_hash().alias("_hash"))
    same = F.col("_own").eqNullSafe(F.col("_first")) & (F.col("_hash") == F.col("_first_hash"))
    return hashed.join(first, same, "left_semi").dropDuplicates(["_own", "_hash"]).select("_whole.*")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of documents with smaller ids; documents that nothing is left of go.

    n_chars, if there is one, is that of the text that is left. Rows with one doc_id are not earlier than one another.
    """
    carried = [F.col(f"`{c}`").alias(f"_in_{c}") for c in docs.columns if c != "text"]  # names that no result column has
    cut = substring.remove_repeated_passages(docs.select("doc_id", "text", *carried), in_place=True).where("n_removed = 0 or n_removed < n_words")
    columns = []
    for c in docs.columns:
        value = F.col(f"`_in_{c}`") if c != "text" else F.col("kept_text")
        if c == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return cut.select(*columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated with passages of the benchmark; an empty benchmark contaminates none."""
    found = decontamination.benchmark_overlap(docs.select("doc_id", "text", _whole(docs)), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select("_whole.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """ids, n_tokens and round_trip instead of the text; columns with these names give way."""
    return pieces.encode(docs, pieces.vocabulary())


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", encoded),
]

#: The stages go beyond SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
