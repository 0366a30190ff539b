"""Registered queries of the operators: each applies one to its whole table, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillstream.session import checkpoint_folder

from . import (
    bpe, chat, decontaminate, exact_dedup, filter_audit, langid, licenses, pii, shards, simhash, spelling, token_counts, token_files,
)
from .common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER, texts=False, digests=True)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = token_counts.TokenRollup(spark, f"{checkpoint_folder(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    return token_counts.recount(rollup, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    log = chat.log_of(rows.unionByName(chat.control_conversation(spark)))
    return chat.digests(chat.format_conversations(log))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER)
    return token_files.read_token_files(manifest)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_report(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_orders(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_pii, op3_exact_dedup, op4_licenses, op5_language, op6_bpe, op7_simhash, op8_decontaminate,
        op9_chat_format, op10_token_files, op11_spelling, op12_shards, op13_filter_audit,
    )
}
