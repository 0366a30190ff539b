"""Message streams derived from the test tables, as JSON in the envelope of the three topics.

Nothing is sampled: every row of `documents`, `pages`, `conversations` and `labels` becomes a message or decides about one.

* documents: English ones go to an index of their source, French and German ones to system indices, Spanish ones to an
  index that begins with `system` but not with `system_`. Low quality labels give a source type that is not allowed;
  a document without a label has a time that cannot be read.
* pages: break three rules each. conversations: each turn is a new version of its conversation, so rows are
  overwritten and shorter turns leave stale tails.
* labels: a toxic document is deleted later; one that is also of high quality is sent again after that, and in English
  deleted again; French documents of high quality are deleted before they come, which finds nothing.
* creations: a labelled document asks for its index, so documents that came before the first of these find none.
"""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import CREATIONS_TOPIC, DELETIONS_TOPIC, DOCUMENTS_TOPIC
from .sizing import broadcast_if_small

# Start times in microseconds of what comes later; messages of one kind are a millisecond apart.
START = 1_735_689_600_000_000
YEAR = 31_536_000_000_000
STEP = 1_000
REQUEST_TIME = "2025-10-22T12:00:00Z"


@cache
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the plan is kept, as reading the schema takes a job each time."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def topic_of(lang: Column, source: Column) -> Column:
    return (
        F.when(lang == "en", F.concat(F.lit("user_"), source, F.lit("_topic")))
        .when(lang == "fr", F.lit("system_topic_1"))
        .when(lang == "de", F.lit("system_topic_2"))
        .otherwise(F.lit("systemes_archive"))
    )


@cache
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three numbers a row; while they are few, the texts of the documents are not shuffled to meet them."""
    return broadcast_if_small(table(spark, sf_dir, "labels"))


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(labels(spark, sf_dir), "doc_id", "left")


def _envelope(topic: str, partition: int, offset: Column, years: int, value: Column) -> list[Column]:
    return [
        F.lit(topic).alias("topic"),
        F.lit(partition).alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.timestamp_micros(F.lit(START + years * YEAR) + offset.cast("bigint") * STEP).alias("timestamp"),
        value.alias("value"),
    ]


def _object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[col.alias(name) for name, col in fields.items()]))


def document_fields() -> dict[str, Column]:
    """Message fields of a row of `labelled_documents`."""
    lang, quality = F.col("lang"), F.col("quality")
    topic = topic_of(lang, F.col("source"))
    return {
        "doc_id": F.col("doc_id").cast("string"),
        "user_id": F.when(lang == "en", F.col("source")),
        "topic_name": F.when(lang == "de", F.concat(F.lit("  "), topic, F.lit("\t"))).otherwise(topic),
        "source_type": F.when(quality == 0, F.lit("plain_text"))
        .when(lang == "fr", F.lit("docx"))
        .when(lang == "de", F.lit("pptx"))
        .otherwise(F.lit("pdf")),
        "document_url": F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string")),
        "upload_time": F.when(quality.isNull(), F.lit("unknown")).otherwise(
            F.concat(
                F.lit("2025-10-22T"),
                F.lpad((F.col("n_chars") % 24).cast("string"), 2, "0"),
                F.when(lang == "en", F.lit(":30:00Z")).otherwise(F.lit(":30:00+03:00")),
            )
        ),
        "text": F.col("text"),
    }


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = labelled_documents(spark, sf_dir)
    fields = _object(**document_fields())
    first = docs.select(*_envelope(DOCUMENTS_TOPIC, 0, F.col("doc_id"), 0, fields))
    again = docs.where("toxic = 1 AND quality = 1").select(*_envelope(DOCUMENTS_TOPIC, 3, F.col("doc_id"), 20, fields))
    pages = table(spark, sf_dir, "pages").select(
        *_envelope(
            DOCUMENTS_TOPIC,
            1,
            F.col("page_id"),
            0,
            _object(
                doc_id=F.concat(F.lit("page-"), F.col("page_id").cast("string")),
                topic_name=F.lit("web_pages"),
                source_type=F.lit("html"),
                document_url=F.col("url"),
                text=F.col("html"),
            ),
        )
    )
    turns = table(spark, sf_dir, "conversations").select(
        *_envelope(
            DOCUMENTS_TOPIC,
            2,
            F.col("conv_id") * 1000 + F.col("turn"),
            0,
            _object(
                doc_id=F.concat(F.lit("conv-"), F.col("conv_id").cast("string")),
                user_id=F.col("role"),
                topic_name=F.lit("user_chat_topic"),
                source_type=F.lit("docx"),
                document_url=F.concat(F.lit("chat/"), F.col("turn").cast("string")),
                upload_time=F.lit(REQUEST_TIME),
                text=F.col("text"),
            ),
        )
    )
    return first.unionByName(again).unionByName(pages).unionByName(turns)


def deletion_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents; benchmark items, which were never sent; pages, whose index does not exist; system turns of
    conversations, with a blank id; English documents that were sent again after their deletion, once more; and French
    ones of high quality, before they are sent at all."""

    def request(doc_id: Column, index_name: Column) -> Column:
        return _object(doc_id=doc_id, index_name=index_name, request_time=F.lit(REQUEST_TIME))

    toxic = labelled_documents(spark, sf_dir).where("toxic = 1")
    padded = F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit("\n"))
    parts = [
        toxic.select(
            *_envelope(DELETIONS_TOPIC, 0, F.col("doc_id"), 10, request(padded, topic_of(F.col("lang"), F.col("source"))))
        ),
        table(spark, sf_dir, "benchmark").select(
            *_envelope(
                DELETIONS_TOPIC,
                1,
                F.col("item_id"),
                10,
                request(F.concat(F.lit("item-"), F.col("item_id").cast("string")), F.lit("system_topic_1")),
            )
        ),
        table(spark, sf_dir, "pages").select(
            *_envelope(
                DELETIONS_TOPIC,
                2,
                F.col("page_id"),
                10,
                request(F.concat(F.lit("page-"), F.col("page_id").cast("string")), F.lit("web_pages")),
            )
        ),
        table(spark, sf_dir, "conversations")
        .where("role = 'system'")
        .select(*_envelope(DELETIONS_TOPIC, 3, F.col("conv_id") * 1000 + F.col("turn"), 10, request(F.lit(" \t "), F.lit("user_chat_topic")))),
    ]
    doc_id, index_name = F.col("doc_id").cast("string"), topic_of(F.col("lang"), F.col("source"))
    parts += [
        toxic.where("quality = 1 AND lang = 'en'").select(*_envelope(DELETIONS_TOPIC, 4, F.col("doc_id"), 30, request(doc_id, index_name))),
        labelled_documents(spark, sf_dir)
        .where("quality = 1 AND lang = 'fr'")
        .select(*_envelope(DELETIONS_TOPIC, 5, F.col("doc_id"), -1, request(doc_id, index_name))),
    ]
    return reduce(DataFrame.unionByName, parts)


def creation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request by each labelled document and each system turn; benchmark items ask for indices that no document can
    reach, and pages for a blank name."""

    def request(name: Column) -> Column:
        return _object(topic_name=name, request_time=F.lit(REQUEST_TIME))

    own = labelled_documents(spark, sf_dir).where("quality IS NOT NULL AND lang IN ('en', 'es')")
    parts = [
        own.select(
            *_envelope(CREATIONS_TOPIC, 0, F.col("doc_id"), 0, request(topic_of(F.col("lang"), F.col("source"))))
        ),
        table(spark, sf_dir, "conversations")
        .where("role = 'system'")
        .select(*_envelope(CREATIONS_TOPIC, 1, F.col("conv_id") * 1000 + F.col("turn"), 0, request(F.lit("user_chat_topic ")))),
        table(spark, sf_dir, "benchmark").select(
            *_envelope(
                CREATIONS_TOPIC, 2, F.col("item_id"), 0, request(F.concat(F.lit("bench_"), F.col("item_id").cast("string")))
            )
        ),
        table(spark, sf_dir, "pages").select(*_envelope(CREATIONS_TOPIC, 3, F.col("page_id"), 0, request(F.lit(" ")))),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
