"""Structured Streaming ingest of the three topics into the change log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.hashing import HashEmbedderFactory
from ..functions.models import Embedder, RetryPolicy
from ..operators import outcomes as O
from ..operators.decode import decode_creations, decode_deletions, decode_documents
from ..operators.embedding import check_dim, chunk_and_embed
from ..operators.index_state import stored, to_index_rows
from ..operators.routing import create_indices, route_all, seed_system_indices
from ..plans.sizing import broadcast_if_small
from ..operators.validate import (
    accepted,
    rejected,
    validate_deletions,
    validate_documents,
    validate_index_creations,
    with_upload_time,
)
from ..schemas import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    CREATIONS_TOPIC,
    DELETIONS_TOPIC,
    DOCUMENTS_TOPIC,
    EMBEDDING_BATCH,
    EMBEDDING_DIM,
    SOURCE_TYPES,
    SYSTEM_TOPICS,
)
from ..session import settle
from ..sources.change_log import ChangeLog
from ..sources.messages import MessageSource, read_deletions, read_documents, read_index_creations


@dataclass(frozen=True)
class IngestSettings:
    size: int = CHUNK_SIZE
    overlap: int = CHUNK_OVERLAP
    dim: int = EMBEDDING_DIM
    batch_size: int = EMBEDDING_BATCH
    source_types: Sequence[str] = SOURCE_TYPES
    system_topics: str = SYSTEM_TOPICS
    enforce_user_scope: bool = False
    embedder: Callable[[], Embedder] | None = None
    retry: RetryPolicy = field(default_factory=RetryPolicy)

    def factory(self) -> Callable[[], Embedder]:
        return self.embedder or HashEmbedderFactory(self.dim)


def parsed_documents(messages: DataFrame, settings: IngestSettings) -> DataFrame:
    return validate_documents(decode_documents(messages), settings.source_types, settings.enforce_user_scope)


def ingest_rows(docs: DataFrame, settings: IngestSettings) -> DataFrame:
    """Index rows and marker rows of documents with their dimension, and their message key; `status` and `reason` are kept
    where documents have them."""
    made = chunk_and_embed(
        with_upload_time(docs), settings.factory(), settings.size, settings.overlap, settings.batch_size, settings.retry
    )
    rows = to_index_rows(check_dim(made, "index_dim"), *[name for name in ("status", "reason") if name in docs.columns])
    return rows.select(
        F.lit(DOCUMENTS_TOPIC).alias("topic"),
        F.col("arrival.partition").alias("partition"),
        F.col("arrival.offset").alias("offset"),
        *rows.columns,
    )


def apply_batch(messages: DataFrame, batch_id: int, log: ChangeLog, settings: IngestSettings) -> None:
    """Bring one batch of messages of all topics into the change log; the same batch again changes nothing.

    Creations take effect before documents and deletes come last for equal times, by the arrival order. Documents are
    looked at once, in a pass that leaves rows of what was stored and marker rows of everything else; outcomes are read
    back from the narrow columns of that. Deletions are judged with the keys of all writes, and those that earlier batches brought
    once more if this batch bears on them. Only creations and deletions, which carry no text, are kept at hand.
    """
    creations = validate_index_creations(decode_creations(messages.where(F.col("topic") == CREATIONS_TOPIC)))
    deletions = validate_deletions(decode_deletions(messages.where(F.col("topic") == DELETIONS_TOPIC)))
    documents = parsed_documents(messages.where(F.col("topic") == DOCUMENTS_TOPIC), settings)
    # a lost block is parsed again from the source
    parsed = [df.persist(StorageLevel.MEMORY_AND_DISK) for df in (creations, deletions)]
    try:
        log.write("registry", batch_id, create_indices(log.registry(batch_id - 1), accepted(creations), settings.dim))
        registry = settle(log.registry(batch_id))
        log.write("deletes", batch_id, accepted(deletions))
        log.write("rows", batch_id, ingest_rows(route_all(documents, registry), settings))
        rows = log.batch("rows", batch_id)
        log.write("keys", batch_id, stored(rows))
        log.write(
            "outcomes",
            batch_id,
            O.union_outcomes(
                O.rejected_outcomes(rejected(creations)),
                O.creation_outcomes(accepted(creations), registry),
                O.rejected_outcomes(rejected(deletions)),
                O.judged_deletion_outcomes(log.judged_deletions(batch_id)),
                O.unrouted_outcomes(rows.where(F.col("status").isNotNull())),
                O.document_outcomes(rows.where(F.col("status").isNull())),
            ),
        )
        log.commit(batch_id)
        log.fold()
    finally:
        for df in parsed:
            df.unpersist()


def prepare(log: ChangeLog, settings: IngestSettings) -> None:
    """Make the system indices that are not there yet; one that is there stays as it was made, whatever the settings say now."""
    seeds = seed_system_indices(log.spark, settings.system_topics, settings.dim)
    fresh = settle(seeds.join(broadcast_if_small(log.registry().select("index_name")), "index_name", "left_anti"))
    if not fresh.isEmpty():
        log.seed(fresh)


@dataclass(frozen=True)
class Sources:
    documents: MessageSource
    deletions: MessageSource
    creations: MessageSource


def read_all(spark: SparkSession, sources: Sources, streaming: bool) -> DataFrame:
    """The three topics as one tagged stream; each source keeps its own offsets."""
    parts = [
        read_documents(spark, sources.documents, streaming),
        read_deletions(spark, sources.deletions, streaming),
        read_index_creations(spark, sources.creations, streaming),
    ]
    parts = [p.withColumn("value", F.col("value").cast("binary")) for p in parts]
    return reduce(DataFrame.unionByName, parts)


def start_ingest(
    spark: SparkSession,
    sources: Sources,
    out: str,
    checkpoint: str,
    settings: IngestSettings = IngestSettings(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the ingest. Offsets live in `checkpoint`, so a restart goes on where it stopped and repeats at most the
    batch that had not been committed, which then replaces itself."""
    log = ChangeLog(spark, out)
    prepare(log, settings)

    def take(df: DataFrame, batch_id: int) -> None:
        # the id of the query is kept in its checkpoint
        log.claim(df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))
        apply_batch(df, batch_id, log, settings)

    writer = read_all(spark, sources, streaming=True).writeStream.foreachBatch(take)
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()


def backfill(
    spark: SparkSession, sources: Sources, out: str, checkpoint: str, settings: IngestSettings = IngestSettings()
) -> None:
    """Read everything from the earliest message on, then end."""
    start_ingest(spark, sources, out, checkpoint, settings, {"availableNow": True}).awaitTermination()
