"""Hand-written messages."""

import json

from pyspark.sql import functions as F

from quillstream.schemas import ENVELOPE

BASE = {
    "doc_id": "d",
    "user_id": "1",
    "topic_name": "user_1_topic",
    "source_type": "pdf",
    "document_url": "u",
    "upload_time": "2025-10-22T12:00:00Z",
    "text": "Hi.",
}


def changed(**fields):
    return json.dumps({k: v for k, v in {**BASE, **fields}.items() if v is not ...})


def document(doc_id, text, index_name="user_1_topic", **fields):
    return changed(doc_id=doc_id, text=text, topic_name=index_name, **fields)


def deletion(doc_id, index_name="user_1_topic"):
    return json.dumps({"doc_id": doc_id, "index_name": index_name, "request_time": "t"})


def creation(topic_name):
    return json.dumps({"topic_name": topic_name, "request_time": "t"})


def envelope(spark, topic, values, start=0):
    """Messages of one topic a second apart; a value may come as (second, value)."""
    timed = [v if isinstance(v, tuple) else (start + n, v) for n, v in enumerate(values)]
    rows = [(topic, 0, at, at, value) for at, value in timed]
    df = spark.createDataFrame(rows, "topic string, `partition` int, `offset` bigint, seconds bigint, value string")
    return df.withColumn("timestamp", F.timestamp_seconds("seconds")).select(*ENVELOPE.names)
