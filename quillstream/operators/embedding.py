"""Vectors for chunks, by a pluggable embedder that is made once per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.arrow import FLUSH_CHARS, expand, vector_array
from ..functions.models import Embedder, RetryPolicy, embed_document
from ..functions.packing import check_window, chunk_spans
from ..plans.sizing import broadcast_if_small
from ..schemas import CHUNK_OVERLAP, CHUNK_SIZE, EMBEDDING_BATCH
from ..session import settle

_EMBEDDED = [
    T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("error", T.StringType()),
]


def _reason(error: Exception) -> str:
    return f"embedding:{type(error).__name__}"


def embed(
    df: DataFrame,
    factory: Callable[[], Embedder],
    batch_size: int = EMBEDDING_BATCH,
    key: Sequence[str] = ("doc_id",),
    retry: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Add `embedding` and `error` to chunk rows.

    A model call never holds texts of two documents, so a failing call touches one document only. Rows of a failed
    call have no vector; `complete_documents` then drops the rest of their document.
    """
    keep, key = list(df.columns), list(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = list(zip(*(batch.column(name).to_pylist() for name in key)))
            vectors: list = []
            errors: list = []
            while len(vectors) < len(texts):
                at = len(vectors)
                stop = at + 1
                while stop < len(texts) and keys[stop] == keys[at]:
                    stop += 1
                try:
                    vectors += embed_document(texts[at:stop], model, batch_size, retry)
                    errors += [None] * (stop - at)
                except Exception as error:  # any failure drops the document, and the job goes on
                    vectors += [None] * (stop - at)
                    errors += [_reason(error)] * (stop - at)
            extra = {"embedding": vector_array(vectors), "error": pa.array(errors, pa.string())}
            yield expand(batch, keep, range(len(texts)), extra)

    return df.mapInArrow(run, T.StructType([df.schema[name] for name in keep] + _EMBEDDED))


def complete_documents(chunks: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Keep only documents in which every chunk has a vector.

    The chunks are settled, so that the model is called once; the keys of documents with a gap are then taken out, and
    while these are few neither text nor vector is shuffled.
    """
    whole = settle(chunks)
    gaps = broadcast_if_small(settle(whole.where(F.col("embedding").isNull()).select(*[F.col(name).alias(f"_{name}") for name in key]).distinct()))
    same = reduce(lambda a, b: a & b, [whole[name].eqNullSafe(gaps[f"_{name}"]) for name in key])
    return whole.join(gaps, same, "left_anti")


def chunk_and_embed(
    docs: DataFrame,
    factory: Callable[[], Embedder],
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    batch_size: int = EMBEDDING_BATCH,
    retry: RetryPolicy = RetryPolicy(),
) -> DataFrame:
    """Chunk and embed in one pass over the documents, with no shuffle.

    The document is the unit of work, so a failed model call drops exactly that document. A document without chunks
    (`error` = `no_chunks`) or with a failed call leaves one marker row whose `chunk_id` is NULL.
    """
    check_window(size, overlap)
    keep = [name for name in docs.columns if name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            rows, ids, texts, counts, vectors, errors, chars = [], [], [], [], [], [], 0
            for row, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").split()
                spans = chunk_spans(words, size, overlap)
                pieces = [" ".join(words[start:end]) for start, end in spans]
                marker = None if pieces else "no_chunks"
                found: list = []
                try:
                    found = embed_document(pieces, model, batch_size, retry)
                except Exception as error:  # any failure drops the document, and the job goes on
                    marker = _reason(error)
                if marker:
                    spans, pieces, found = [(None, None)], [None], [None]
                rows += [row] * len(pieces)
                ids += [None] if marker else range(len(pieces))
                texts += pieces
                counts += [None] if marker else (end - start for start, end in spans)
                vectors += found
                errors += [marker] * len(pieces)
                chars += sum(len(piece or "") for piece in pieces)
                if chars >= FLUSH_CHARS or row == batch.num_rows - 1:
                    extra = {
                        "chunk_id": pa.array(ids, pa.int32()),
                        "text": pa.array(texts, pa.string()),
                        "n_words": pa.array(counts, pa.int32()),
                        "embedding": vector_array(vectors),
                        "error": pa.array(errors, pa.string()),
                    }
                    yield expand(batch, keep, rows, extra)
                    rows, ids, texts, counts, vectors, errors, chars = [], [], [], [], [], [], 0

    schema = T.StructType(
        [docs.schema[name] for name in keep]
        + [
            T.StructField("chunk_id", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.IntegerType()),
        ]
        + _EMBEDDED
    )
    return docs.select(*keep, "text").mapInArrow(run, schema)


def check_dim(df: DataFrame, dim: int | str) -> DataFrame:
    """Mark rows whose vector has another dimension than the index, given as a number or as the column that holds it;
    earlier errors stay."""
    wanted = F.col(dim) if isinstance(dim, str) else F.lit(dim)
    wrong = F.concat(F.lit("dimension:"), F.size("embedding").cast("string"))
    return df.withColumn(
        "error",
        F.coalesce("error", F.when(F.col("embedding").isNotNull() & (F.size("embedding") != wanted), wrong)),
    )


def dim_report(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Vectors by index and dimension, refused ones too, beside the dimension the index was made for."""
    counts = rows.where(F.col("embedding").isNotNull()).groupBy("index_name", F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n_rows"))
    wanted = registry.select("index_name", F.col("dim").alias("index_dim"))
    return counts.join(wanted, "index_name", "left").withColumn("matches", F.col("dim") == F.col("index_dim"))


def calls(recorded: DataFrame, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Model calls by document, from chunk rows with the size of their call (`n_texts`) and their place in it: the number
    of the call, its texts, and its first and last chunk. A call is named by its first chunk."""
    found = recorded.groupBy(*key, (F.col("chunk_id") - F.col("place")).alias("first_chunk"), "n_texts").agg(
        F.max("chunk_id").alias("last_chunk"), F.count(F.lit(1)).alias("_rows")
    )
    in_order = Window.partitionBy(*key).orderBy("first_chunk")
    return found.select(
        *key,
        (F.row_number().over(in_order) - 1).alias("batch_no"),
        F.when(F.col("_rows") == F.col("n_texts"), F.col("n_texts").cast("bigint")).alias("n_texts"),
        "first_chunk",
        "last_chunk",
    )


def order_by_index(responses: DataFrame) -> DataFrame:
    """Vectors of model responses in the order of the returned `index`.

    `data` is array<struct<index, embedding>>; the result has `position` and `embedding` beside the other columns.
    """
    keep = [name for name in responses.columns if name != "data"]
    ordered = F.array_sort(F.transform("data", lambda item: F.struct(item["index"].alias("index"), item["embedding"].alias("embedding"))))
    return responses.select(*keep, F.posexplode(ordered).alias("position", "_item")).select(
        *keep, "position", F.col("_item.embedding").alias("embedding")
    )
