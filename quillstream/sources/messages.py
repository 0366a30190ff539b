"""Message sources: Kafka topics, or files and tables in the same envelope."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schemas import CREATIONS_TOPIC, DELETIONS_TOPIC, DOCUMENTS_TOPIC, ENVELOPE


# Most that one batch of a stream takes from a source; the rest comes in the next batches, so a backlog of any size is
# worked off in batches of bounded size. Options of the source override them.
OFFSETS_PER_TRIGGER = 1_000_000
FILES_PER_TRIGGER = 1_000


@dataclass(frozen=True)
class MessageSource:
    """Where one topic is read from.

    `format="kafka"` needs the Kafka connector on the class path and the option `kafka.bootstrap.servers`; any file
    format (`json`, `parquet`) reads `path` in the envelope schema. `options` go to the reader.
    """

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def kafka(servers: str, group_prefix: str | None = None, **options: str) -> MessageSource:
    """A Kafka source; each query that reads it keeps its own offsets in its checkpoint."""
    settings = {"kafka.bootstrap.servers": servers, **options}
    if group_prefix:
        settings["groupIdPrefix"] = group_prefix
    return MessageSource("kafka", options=settings)


def read_messages(spark: SparkSession, source: MessageSource, topic: str, streaming: bool = False) -> DataFrame:
    """Envelope rows of one topic, from the earliest message on."""
    reader = spark.readStream if streaming else spark.read
    limit = {}
    if streaming and not any(name.lower().startswith("max") and name.lower().endswith("pertrigger") for name in source.options):
        kafka_limit = {"maxOffsetsPerTrigger": str(OFFSETS_PER_TRIGGER)}
        limit = kafka_limit if source.format == "kafka" else {"maxFilesPerTrigger": str(FILES_PER_TRIGGER)}
    if source.format == "kafka":
        options = {"subscribe": topic, "startingOffsets": "earliest", **limit, **source.options}
        raw = reader.format("kafka").options(**options).load()
        return raw.select("topic", "partition", "offset", "timestamp", "value")
    raw = reader.format(source.format).schema(ENVELOPE).options(**limit, **source.options).load(source.path)
    return raw.withColumn("topic", F.lit(topic))


def read_documents(spark: SparkSession, source: MessageSource, streaming: bool = False) -> DataFrame:
    return read_messages(spark, source, DOCUMENTS_TOPIC, streaming)


def read_deletions(spark: SparkSession, source: MessageSource, streaming: bool = False) -> DataFrame:
    return read_messages(spark, source, DELETIONS_TOPIC, streaming)


def read_index_creations(spark: SparkSession, source: MessageSource, streaming: bool = False) -> DataFrame:
    return read_messages(spark, source, CREATIONS_TOPIC, streaming)
