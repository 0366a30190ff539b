"""The index registry and the routing of documents to indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.ids import index_kind
from ..functions.text import strip
from ..plans.sizing import broadcast_if_small
from ..schemas import EMBEDDING_DIM, REGISTRY, SYSTEM_TOPICS


def seed_system_indices(spark: SparkSession, topics: str = SYSTEM_TOPICS, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Registry rows of the system indices named in a comma list; they exist before any message."""
    return (
        spark.range(1)
        .select(F.explode(F.split(F.lit(topics), ",")).alias("_topic"))
        .select(F.concat(F.lit("system_"), strip(F.col("_topic"))).alias("index_name"))
        .distinct()
        .select(
            "index_name",
            index_kind(F.col("index_name")).alias("kind"),
            F.lit(dim).cast("int").alias("dim"),
            F.struct(
                F.timestamp_micros(F.lit(0)).alias("timestamp"),
                F.lit(0).alias("rank"),
                F.lit(-1).alias("partition"),
                F.lit(-1).cast("bigint").alias("offset"),
            ).alias("created"),
        )
    )


def create_indices(registry: DataFrame, creations: DataFrame, dim: int = EMBEDDING_DIM) -> DataFrame:
    """Registry rows to append: the first request for each index that does not exist yet."""
    first = creations.groupBy("index_name").agg(F.min("arrival").alias("created"))
    known = broadcast_if_small(registry.select("index_name"))
    fresh = first.join(known, "index_name", "left_anti")
    return fresh.select(
        "index_name",
        index_kind(F.col("index_name")).alias("kind"),
        F.lit(dim).cast("int").alias("dim"),
        F.col("created").cast(REGISTRY["created"].dataType).alias("created"),
    )


def _known(docs: DataFrame, registry: DataFrame, *extra: str) -> tuple[DataFrame, Column]:
    renamed = [F.col("index_name").alias("_index"), F.col("created").alias("_created"), *extra]
    known = broadcast_if_small(registry.select(*renamed))
    return known, (docs["index_name"] == known["_index"]) & (known["_created"] < docs["arrival"])


def route_existing(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """Documents whose index was created before they arrived, with `index_dim`, the dimension it was made for."""
    known, condition = _known(docs, registry, "dim")
    return docs.join(known, condition).select(*[docs[name] for name in docs.columns], known["dim"].alias("index_dim"))


def route_missing(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """Documents whose index does not exist, or did not when they arrived."""
    known, condition = _known(docs, registry)
    return docs.join(known, condition, "left_anti")


def route_all(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """All documents in one pass: `status` is `rejected`, `missing_index`, or NULL for a document that goes to its index, and
    only these keep their text; `reason` has the errors, `index_dim` the dimension."""
    known, condition = _known(docs, registry, "dim")
    joined = docs.join(known, condition, "left")
    status = F.when(F.size("errors") > 0, F.lit("rejected")).when(F.col("_index").isNull(), F.lit("missing_index"))
    columns = [F.when(status.isNull(), F.col("text")).alias("text") if name == "text" else docs[name] for name in docs.columns if name != "errors"]
    return joined.select(*columns, F.col("errors").alias("reason"), status.alias("status"), F.col("dim").alias("index_dim"))


def system_ready(registry: DataFrame, topics: str = SYSTEM_TOPICS) -> DataFrame:
    """One row by system index: is it in the registry?"""
    wanted = seed_system_indices(registry.sparkSession, topics).select("index_name")
    known = registry.groupBy("index_name").agg(F.lit(True).alias("found"))
    return wanted.join(known, "index_name", "left").select(
        "index_name", F.coalesce("found", F.lit(False)).alias("ready")
    )


def all_system_ready(registry: DataFrame, topics: str = SYSTEM_TOPICS) -> DataFrame:
    return system_ready(registry, topics).agg(
        F.bool_and("ready").alias("all_ready"),
        F.count_if("ready").alias("n_ready"),
        F.count(F.lit(1)).alias("n_wanted"),
    )
