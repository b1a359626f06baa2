"""From raw documents to packed training sequences: the stages of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siteplan.llm import decontam, langid, minhash, packing, toxicity
from siteplan.llm.queries import TOXIC, table, tokenizer_files
from siteplan.session import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the four languages."""
    return langid.in_language(docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model learned from the labels of these documents."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (similarity 0.8 of 5-word shingles)."""
    return minhash.distinct_documents(docs, (80, 100))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 2048."""
    return packing.packed(docs, *tokenizer_files())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates),
                                   ("decontamination", benchmark), ("packing", packed)]
ORACLE_SQL = None  # trained models, hashing and tokenizers: see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
