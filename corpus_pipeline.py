"""The corpus pipeline: language ID, near-dedup, substring dedup and packing of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graphloom.llm.langid import accepted_documents
from graphloom.llm.neardup import one_of_each_group
from graphloom.llm.packing import pack_documents
from graphloom.llm.runtime import saved
from graphloom.llm.substring import without_repeats


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without a letter, or with no likely language, go."""
    return accepted_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return one_of_each_group(docs, 5, 75)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 13 words or more that an earlier one holds."""
    return without_repeats(docs, 13)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return pack_documents(docs, 4096)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]

#: SQL has no conditional random field and no tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
