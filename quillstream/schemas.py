"""Fixed schemas of messages and of the stored tables."""

from pyspark.sql import types as T

_S = T.StringType()


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


# Field names of the three message classes, in order of declaration.
DOCUMENT_FIELDS = ("doc_id", "user_id", "topic_name", "source_type", "document_url", "upload_time", "text")
DELETION_FIELDS = ("doc_id", "index_name", "request_time")
CREATION_FIELDS = ("topic_name", "request_time")

# Default topics of the three consumers.
DOCUMENTS_TOPIC = "documents"
DELETIONS_TOPIC = "document_deletions"
CREATIONS_TOPIC = "index_creations"

# Default settings.
SOURCE_TYPES = ("pdf", "pptx", "docx")
CHUNK_SIZE = 1400
CHUNK_OVERLAP = 150
EMBEDDING_DIM = 256
EMBEDDING_BATCH = 10
SYSTEM_TOPICS = "topic_1,topic_2,topic_3,topic_4,topic_5"

ENVELOPE = _fields(
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("timestamp", T.TimestampType()),
    ("value", _S),
)

# Total order over messages of all topics; compares field by field.
ARRIVAL = _fields(
    ("timestamp", T.TimestampType()),
    ("rank", T.IntegerType()),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
)

REGISTRY = _fields(
    ("index_name", _S),
    ("kind", _S),
    ("dim", T.IntegerType()),
    ("created", ARRIVAL),
)

DELETES = _fields(("index_name", _S), ("doc_id", _S), ("arrival", ARRIVAL))

INDEX_ROW = _fields(
    ("index_name", _S),
    ("row_id", _S),
    ("doc_id", _S),
    ("chunk_id", T.IntegerType()),
    ("text", _S),
    ("n_words", T.IntegerType()),
    ("source_type", _S),
    ("document_url", _S),
    ("metadata", T.MapType(_S, _S)),
    ("user_id", _S),
    ("upload_time", T.TimestampType()),
    ("user_upload_time", T.TimestampType()),
    ("upload_time_raw", _S),
    ("embedding", T.ArrayType(T.FloatType())),
    ("error", _S),
    ("arrival", ARRIVAL),
)

OUTCOME = _fields(
    ("topic", _S),
    ("partition", T.IntegerType()),
    ("offset", T.LongType()),
    ("doc_id", _S),
    ("index_name", _S),
    ("status", _S),
    ("reason", T.ArrayType(_S)),
    ("n_chunks", T.LongType()),
)
