"""Corpus cleaning in stages: language, near copies, benchmark passages, personal data, tokens.

Each stage takes what the one before kept, as written Parquet, and returns the
columns of ``documents`` (the last one the token ids and their decoded text).  A lost executor
repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontaminate, langid, minhash, pii
from strata.session import cut_lineage
from strata.sources.tables import read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without text, letters or an identifiable language."""
    return langid.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document (the smallest doc_id) of each near-duplicate group."""
    return minhash.drop_near_duplicates(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by marks."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    return bpe.decode_ids(bpe.encode(docs))


STAGES = [
    ("language ID", language),
    ("MinHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]

#: Trained stages and merges can't be stated in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut_lineage(docs, f"pipeline-{i + 1}")
    return docs
