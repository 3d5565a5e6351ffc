"""The corpus pipeline: filter, deduplicate, decontaminate and tokenize ``documents``.

Every stage takes the documents that the one before it kept, as Parquet in the shared
folder, and returns rows with the columns of ``documents``; the last returns one row with
the token ids and their figures for each document that is left. Nulls, empty texts, repeated rows and
empty tables have the results that the operators define; extra columns pass through to
the last stage, which takes doc_id and text only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlab.llm import op05_quality, op06_decontaminate, op07_simhash_dedup, op08_exact_dedup, op09_sentencepiece
from cohortlab.llm.common import stage, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op05_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op08_exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op07_simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op06_decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op09_sentencepiece.encode(docs)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

# The quality model and the tokenizer have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
