"""Keys and kinds of indices, rows and messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Order of topics for messages with the same time.
CREATE_RANK, DOCUMENT_RANK, DELETE_RANK = 0, 1, 2


def topic_type(col: Column) -> Column:
    return F.when(col.startswith("user"), F.lit("user")).otherwise(F.lit("system"))


def index_kind(col: Column) -> Column:
    """Storage kind of an index; stricter than the topic type, so 'systemfoo' is a user index."""
    return F.when(col.startswith("system_"), F.lit("system")).otherwise(F.lit("user"))


def row_id(doc_id: Column, chunk_id: Column) -> Column:
    return F.concat(doc_id, F.lit("_"), chunk_id.cast("string"))


def arrival(rank: int) -> Column:
    """Place of an envelope row in the order over all topics."""
    return F.struct(
        F.col("timestamp"),
        F.lit(rank).alias("rank"),
        F.col("partition"),
        F.col("offset"),
    )
