"""From documents to token files: the stages of a training corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm.base import table, written
from eventloom.llm.contamination import decontaminated
from eventloom.llm.fertility import of_quality
from eventloom.llm.mixing import mixed
from eventloom.llm.orderhash import one_of_each
from eventloom.llm.tokenfiles import read_token_files, write_token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of tokeniser fertility keep."""
    return of_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items; those that are mostly such passages go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled with the probabilities of the raked mix."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all texts, and what they hold of every document."""
    return read_token_files(write_token_files(docs))


STAGES = [
    ("quality rules", quality),
    ("near-duplicate removal", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixing),
    ("token files", tokens),
]

#: The tokenizers, the sketches and the raking have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if number == 0 else written(docs), sf_dir)
    return docs
