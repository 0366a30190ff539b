"""The corpus pipeline: five operators, each on what the one before kept.

Language identification drops texts without a language, exact deduplication keeps the last of equal texts, SimHash
deduplication keeps one document of each group, decontamination drops documents with benchmark passages, and the
byte-pair encoder returns what is left as token ids. Each stage reads the table that the one before wrote. All but the
last return the columns of their input, whatever these are; nulls, empty and repeated rows are treated as each operator
says, and an empty table stays one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillstream.llm import bpe, decontaminate, exact_dedup, langid, simhash
from quillstream.session import checkpoint_folder, configure

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return bpe.encode(docs, TOKENIZER, texts=False, digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("bpe_encoding", encode),
]

# Stages 1, 3 and 5 are beyond SQL; tests/llm/test_pipeline.py holds the rows against a version by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between them the rows lie in the checkpoint folder."""
    configure(spark)
    folder = f"{checkpoint_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
