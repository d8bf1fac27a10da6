"""Corpus pipeline over ``documents``: quality, near duplicates, benchmark leaks, personal data, packing.

Every stage takes what the one before it kept, written as Parquet and read again. All but the last return
the columns of ``documents``; the last returns the pieces of the packed sequences with their token ids.

Cases: null and empty texts are rejected by the first stage; nulls in other columns, repeated rows and
further columns pass through, except that equal rows become one in the second stage; empty tables give an
empty result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm import decontamination, ngram_join, packing, pii, quality
from meterlake.llm.common import read_table, ship_package, stored
from meterlake.llm.tokenizer_files import public_byte_bpe


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship_package(spark)
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship_package(spark)
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets."""
    return pii.masked(docs)


def token_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, and their places in the packed sequences."""
    ship_package(spark)
    return packing.pack(docs, public_byte_bpe())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("packing", token_packing),
]

#: No stage can be said in SQL; tests/llm hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
