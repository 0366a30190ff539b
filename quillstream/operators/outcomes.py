"""One outcome per message, and totals of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import DELETIONS_TOPIC, OUTCOME

MESSAGE_KEY = ["topic", "partition", "offset"]


def _none() -> Column:
    return F.lit(None).cast("string")


def _reasons(*codes: Column) -> Column:
    return F.array(*codes).cast("array<string>")


def _outcome(df: DataFrame, doc_id: Column, index_name: Column, status: Column, reason: Column, n: Column) -> DataFrame:
    return df.select(
        *MESSAGE_KEY,
        doc_id.alias("doc_id"),
        index_name.alias("index_name"),
        status.alias("status"),
        reason.cast("array<string>").alias("reason"),
        n.cast(OUTCOME["n_chunks"].dataType).alias("n_chunks"),
    )


def rejected_outcomes(messages: DataFrame) -> DataFrame:
    """Outcomes of messages that failed validation."""
    doc_id = F.col("doc_id") if "doc_id" in messages.columns else _none()
    return _outcome(messages, doc_id, F.col("index_name"), F.lit("rejected"), F.col("errors"), F.lit(0))


def missing_index_outcomes(docs: DataFrame) -> DataFrame:
    return _outcome(
        docs, F.col("doc_id"), F.col("index_name"), F.lit("missing_index"), _reasons(), F.lit(0)
    )


def unrouted_outcomes(rows: DataFrame) -> DataFrame:
    """Outcomes of documents that went to no index, from their marker rows."""
    return _outcome(rows, F.col("doc_id"), F.col("index_name"), F.col("status"), F.col("reason"), F.lit(0))


def document_outcomes(rows: DataFrame) -> DataFrame:
    """Outcomes of routed documents, from the rows and marker rows that chunking and embedding left."""
    ok = F.col("chunk_id").isNotNull() & F.col("error").isNull()
    counted = rows.groupBy(*MESSAGE_KEY, "doc_id", "index_name").agg(
        F.count_if(ok).alias("_ok"),
        F.count("chunk_id").alias("_chunks"),
        F.array_sort(F.collect_set("error")).alias("_errors"),
    )
    status = (
        F.when((F.col("_ok") > 0) & (F.col("_ok") == F.col("_chunks")), F.lit("indexed"))
        .when(F.col("_ok") > 0, F.lit("indexed_partial"))
        .when(F.array_contains("_errors", "no_chunks"), F.lit("no_chunks"))
        .otherwise(F.lit("failed"))
    )
    return _outcome(counted, F.col("doc_id"), F.col("index_name"), status, F.col("_errors"), F.col("_ok"))


def creation_outcomes(creations: DataFrame, registry: DataFrame) -> DataFrame:
    """`created` for the request that made the index, `exists` for later ones; `registry` includes the new rows."""
    made = registry.select("index_name", F.col("created").alias("_created"))
    joined = creations.join(made, "index_name", "left")
    status = F.when(F.col("arrival") == F.col("_created"), F.lit("created")).otherwise(F.lit("exists"))
    return _outcome(joined, _none(), F.col("index_name"), status, _reasons(), F.lit(0))


def judged_deletion_outcomes(judged: DataFrame, topic: str = DELETIONS_TOPIC) -> DataFrame:
    """Outcomes of valid deletions from what they did (`index_state.deletion_outcomes`): `missing_index`, `nothing_found`, or
    `deleted` with the number of rows."""
    keyed = judged.withColumns({"topic": F.lit(topic), "partition": F.col("arrival.partition"), "offset": F.col("arrival.offset")})
    return _outcome(keyed, F.col("doc_id"), F.col("index_name"), F.col("status"), _reasons(), F.col("n_deleted"))


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """Of the outcomes of each message that of the last batch, with that `batch_id`."""
    values = [name for name in outcomes.columns if name not in MESSAGE_KEY]
    last = outcomes.groupBy(*MESSAGE_KEY).agg(F.max_by(F.struct(*values), "batch_id").alias("_last"))
    return last.select(*[f"_last.{name}" if name in values else name for name in outcomes.columns])


def union_outcomes(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Messages by topic, status and reason; a message with several reasons counts once under each."""
    return (
        outcomes.select("topic", "status", F.explode_outer("reason").alias("reason"), "n_chunks")
        .groupBy("topic", "status", "reason")
        .agg(F.count(F.lit(1)).alias("n_messages"), F.sum("n_chunks").alias("n_chunks"))
    )
