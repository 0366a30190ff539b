"""Registered queries: each runs one operator of the library over whole test tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillstream.functions.hashing import HashEmbedderFactory
from quillstream.functions.ids import index_kind, row_id, topic_type
from quillstream.functions.text import analyze
from quillstream.functions.times import parse_upload_time
from quillstream.operators import cells, chunking, embedding, index_state, inverted, outcomes, search
from quillstream.operators.decode import decode_creations, decode_deletions, decode_documents
from quillstream.operators.routing import all_system_ready, seed_system_indices
from quillstream.operators.validate import (
    accepted,
    validate_deletions,
    validate_documents,
    validate_index_creations,
)
from quillstream.plans import derived
from quillstream.plans.derived import table
from quillstream.plans.replay import Replay, registry_of, replay
from quillstream.plans.sizing import packed, spread
from quillstream.schemas import ENVELOPE
from quillstream.session import checkpoint_folder, configure, discard, settle, settled_path
from quillstream.sources.change_log import ChangeLog
from quillstream.sources.messages import MessageSource, read_deletions, read_documents, read_index_creations
from quillstream.streaming.ingest import IngestSettings, Sources, apply_batch, backfill, prepare

DIM = 64
K = 10
SMALL = IngestSettings(size=40, overlap=10, dim=DIM)
FULL = IngestSettings(dim=DIM)


# Inputs


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def replayed(spark: SparkSession, sf_dir: str, settings: IngestSettings) -> Replay:
    configure(spark)
    return replay(
        spread(derived.document_messages(spark, sf_dir), "partition", "offset"),
        derived.deletion_messages(spark, sf_dir),
        derived.creation_messages(spark, sf_dir),
        settings,
    )


def micros(name: str) -> Column:
    return F.unix_micros(F.col(name)).alias(f"{name}_us")


def text_md5() -> Column:
    return F.md5(F.col("text").cast("binary")).alias("text_md5")


def joined(name: str) -> Column:
    return F.array_join(F.col(name), "|").alias(name)


def index_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        "index_name",
        "row_id",
        "doc_id",
        "chunk_id",
        "n_words",
        text_md5(),
        "source_type",
        "document_url",
        "user_id",
        micros("upload_time"),
        micros("user_upload_time"),
        "upload_time_raw",
        F.size("metadata").alias("n_metadata"),
        F.col("arrival.offset").alias("offset"),
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select(
        derived.topic_of(F.col("lang"), F.col("source")).alias("index_name"),
        F.col("doc_id").cast("string").alias("doc_id"),
        "lang",
        "text",
    )


def _with_row_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("row_id", row_id(F.col("doc_id"), F.col("chunk_id")))


def text_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as an index without vectors, stored, as an index is: chunks in the index of their topic."""
    return settle(_with_row_id(chunking.chunk_text(_texts(spark, sf_dir))))


def chunk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with hash vectors."""
    rows = embedding.chunk_and_embed(_texts(spark, sf_dir), HashEmbedderFactory(DIM))
    return settle(_with_row_id(rows.where(F.col("chunk_id").isNotNull())))


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return spread(vectors, "vec_id").select(
        F.lit("vectors").alias("index_name"), F.col("vec_id").alias("row_id"), "embedding", "label"
    )


def lsh_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors with their buckets, stored: a search reads them for each block of queries, in tasks of their own."""
    return settle(search.with_lsh(vector_index(spark, sf_dir), DIM))


def row_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row whose id is divisible by 20: the queries grow with the table."""
    rows = table(spark, sf_dir, "embeddings").where("vec_id % 20 = 0")
    return rows.select(F.col("vec_id").alias("query_id"), "embedding")


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return embedding.embed(items, HashEmbedderFactory(DIM), key=["query_id"]).select("query_id", "text", "embedding")


# Sources


def _source_view(messages: DataFrame, field: str) -> DataFrame:
    return messages.select(
        "topic",
        "partition",
        "offset",
        micros("timestamp"),
        F.get_json_object("value", f"$.{field}").alias(field),
    )


# A file is split by its row groups, so a batch of a few large files is still work for all cores.
ROW_GROUP_BYTES = 8 << 20


def _through_source(messages: DataFrame) -> MessageSource:
    """The messages as files whose number follows their size, not the splits that the tables are read in."""
    files = packed(messages.select(*ENVELOPE.names), "partition", "offset")
    return MessageSource("parquet", settled_path(files, **{"parquet.block.size": str(ROW_GROUP_BYTES)}))


def src_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _source_view(read_documents(spark, _through_source(derived.document_messages(spark, sf_dir))), "doc_id")


def src_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return _source_view(read_deletions(spark, _through_source(derived.deletion_messages(spark, sf_dir))), "doc_id")


def src_index_creations(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    source = _through_source(derived.creation_messages(spark, sf_dir))
    return _source_view(read_index_creations(spark, source), "topic_name")


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document messages as they are, conversation turns as bare text, pages inside a JSON array."""
    configure(spark)
    messages = derived.document_messages(spark, sf_dir)
    text = F.get_json_object("value", "$.text")
    values = messages.withColumn(
        "value",
        F.when(F.col("partition") == 2, text)
        .when(F.col("partition") == 1, F.concat(F.lit("["), F.col("value"), F.lit("]")))
        .otherwise(F.col("value")),
    )
    decoded = decode_documents(spread(values, "partition", "offset"))
    return decoded.select(
        "partition",
        "offset",
        "json_status",
        F.col("doc_id.text").alias("doc_id"),
        F.col("user_id.kind").alias("user_id_kind"),
        F.col("topic_name.text").alias("topic_name"),
        F.md5(F.col("text.text").cast("binary")).alias("text_md5"),
    )


# Validation


def _checked_view(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("partition", "offset", *columns, joined("errors"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return decode_documents(spread(derived.document_messages(spark, sf_dir), "partition", "offset"))


def validated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate_documents(_documents(spark, sf_dir)).withColumn("n_chars", F.length("text").cast("bigint"))
    return _checked_view(checked, "doc_id", "user_id", "index_name", "source_type", "upload_time", "n_chars")


def validated_user_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents come without a user, all others with one, whatever their topic needs."""
    configure(spark)
    fields = derived.document_fields()
    fields["user_id"] = F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 0, F.col("source"))
    messages = derived.labelled_documents(spark, sf_dir).select(
        F.lit(0).alias("partition"),
        F.col("doc_id").alias("offset"),
        F.timestamp_micros(F.lit(derived.START)).alias("timestamp"),
        F.to_json(F.struct(*[col.alias(name) for name, col in fields.items()])).alias("value"),
    )
    checked = validate_documents(decode_documents(spread(messages, "offset")), enforce_user_scope=True)
    return _checked_view(checked, "doc_id", "user_id", "index_name")


def validated_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    checked = validate_deletions(decode_deletions(derived.deletion_messages(spark, sf_dir)))
    return _checked_view(checked, "doc_id", "index_name", "request_time")


def validated_creations(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    checked = validate_index_creations(decode_creations(derived.creation_messages(spark, sf_dir)))
    return _checked_view(checked, "index_name", "request_time")


def topic_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = derived.topic_of(F.col("lang"), F.col("source"))
    return docs(spark, sf_dir).select(
        "doc_id", topic.alias("topic_name"), topic_type(topic).alias("topic_type"), index_kind(topic).alias("index_kind")
    )


def upload_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times in five forms, by event type; sign-ups carry no time at all."""
    configure(spark)
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    raw = (
        F.when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd HH:mm:ss'+0300'"))
        .when(kind == "view", F.date_format(ts, "yyyyMMdd'T'HHmmss"))
        .when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.lit("T12:00"))
    )
    events = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return events.select("event_id", F.unix_micros(parse_upload_time(F.col("raw"))).alias("time_us"))


# Routing and registry


def created_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    creations = validate_index_creations(decode_creations(derived.creation_messages(spark, sf_dir)))
    return registry_of(creations, SMALL).select(
        "index_name", "kind", "dim", F.unix_micros("created.timestamp").alias("created_us")
    )


def system_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded indices with the valid documents sent to each."""
    sent = accepted(validate_documents(_documents(spark, sf_dir))).groupBy("index_name").agg(
        F.count(F.lit(1)).alias("n_messages")
    )
    seeds = seed_system_indices(spark, dim=DIM)
    return seeds.select("index_name", "kind", "dim").join(sent, "index_name", "left").na.fill(0, ["n_messages"])


def system_indices_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which system indices are there, in a registry of those that some document went to."""
    state = replayed(spark, sf_dir, SMALL)
    used = state.registry.join(state.routed.select("index_name").distinct(), "index_name", "left_semi")
    return all_system_ready(used)


def route_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed(spark, sf_dir, SMALL).routed.select("partition", "offset", "doc_id", "index_name")


def route_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replayed(spark, sf_dir, SMALL).missing.select("partition", "offset", "doc_id", "index_name")


# Chunking


def _chunk_view(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", "chunk_id", "n_words", text_md5())


def _chunks(spark: SparkSession, sf_dir: str, settings: IngestSettings) -> DataFrame:
    return chunking.chunk_text(docs(spark, sf_dir).select("doc_id", "text"), settings.size, settings.overlap)


def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_view(_chunks(spark, sf_dir, FULL))


def chunk_documents_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunk_view(_chunks(spark, sf_dir, SMALL))


def split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.sentences(docs(spark, sf_dir).select("doc_id", "text"))


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.word_counts(docs(spark, sf_dir).select("doc_id", "text"))


def long_sentence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.long_sentence_windows(docs(spark, sf_dir).select("doc_id", "text"), SMALL.size, SMALL.overlap)


def chunk_overlap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the chunks of a document repeat, and whether the longest chunk keeps its bound."""
    sizes = (
        _chunks(spark, sf_dir, SMALL)
        .groupBy("doc_id")
        .agg(F.sum("n_words").alias("chunk_words"), F.max("n_words").alias("longest_chunk"))
    )
    return word_counts(spark, sf_dir).join(sizes, "doc_id").select(
        "doc_id",
        (F.col("chunk_words") - F.col("n_words")).alias("repeated_words"),
        "longest_chunk",
        (F.col("longest_chunk") <= SMALL.size + SMALL.overlap).alias("within_bound"),
    )


def chunks_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunks_per_document(_chunks(spark, sf_dir, FULL), "doc_id")


def empty_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of low quality with every word taken out, so that white space is all they hold."""
    configure(spark)
    labelled = derived.labelled_documents(spark, sf_dir)
    blanked = labelled.select(
        "doc_id",
        F.when(F.col("quality") == 0, F.regexp_replace("text", r"\S", " ")).otherwise(F.col("text")).alias("text"),
    )
    made = embedding.chunk_and_embed(spread(blanked, "doc_id"), HashEmbedderFactory(DIM))
    return made.where(F.col("error") == "no_chunks").select("doc_id", "error")


# Embedding


def chunk_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = embedding.embed(_chunks(spark, sf_dir, FULL), HashEmbedderFactory(DIM))
    whole = embedding.complete_documents(made)
    weighed = F.aggregate(
        F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, b: a + b
    )
    return whole.select(
        "doc_id",
        "chunk_id",
        F.size(F.filter("embedding", lambda x: x != 0)).alias("n_places"),
        F.round(weighed, 4).alias("weighed"),
    )


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = embedding.embed(docs(spark, sf_dir).select("doc_id", "text"), HashEmbedderFactory(DIM))
    cells = made.select("doc_id", F.posexplode("embedding").alias("place", "x"))
    return cells.where("x != 0").select("doc_id", "place", F.round(F.col("x").cast("double"), 5).alias("x"))


def _call_recorder():
    """An embedder whose vectors tell the call: how many texts it had, and which one this was; items come in falling order."""

    def factory():
        return lambda texts: [{"index": i, "embedding": [len(texts), i]} for i in reversed(range(len(texts)))]

    return factory


def embedding_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model calls that chunking and embedding makes, told by what the model was given."""
    texts = docs(spark, sf_dir).select("doc_id", "text")
    rows = embedding.chunk_and_embed(texts, _call_recorder(), SMALL.size, SMALL.overlap, batch_size=K).where("chunk_id IS NOT NULL")
    size, place = (F.col("embedding")[i].cast("int") for i in (0, 1))
    return embedding.calls(rows.select("doc_id", "chunk_id", size.alias("n_texts"), place.alias("place")))


def order_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as model responses of ten, given back in falling order of their value, then put in order."""
    configure(spark)
    item = F.struct(F.col("vec_id").alias("index"), "embedding")
    # at most ten rows in a group
    responses = (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.floor(F.col("vec_id") / 10).alias("call"))
        .agg(F.reverse(F.array_sort(F.collect_list(item))).alias("data"))
    )
    ordered = embedding.order_by_index(responses)
    return ordered.select("call", "position", F.round(F.col("embedding")[0].cast("double"), 5).alias("first_value"))


def _odd_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small chunks in which those above the chunk size got a vector of half the dimension."""
    rows = embedding.embed(_chunks(spark, sf_dir, SMALL), HashEmbedderFactory(DIM))
    half = F.when(F.col("n_words") > SMALL.size, F.slice("embedding", 1, DIM // 2)).otherwise(F.col("embedding"))
    return embedding.check_dim(rows.withColumn("embedding", half), DIM)


def embedding_dim_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _odd_vectors(spark, sf_dir).where(F.col("error").isNotNull()).select("doc_id", "chunk_id", "error")


def index_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_state.index_outcomes(_odd_vectors(spark, sf_dir), ("doc_id",))


def dim_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors beside a registry whose system indices were made for half the dimension."""
    state = replayed(spark, sf_dir, FULL)
    halved = F.when(F.col("kind") == "system", F.lit(DIM // 2)).otherwise(F.col("dim")).cast("int")
    state = replace(state, registry=settle(state.registry.withColumn("dim", halved)))
    return embedding.dim_report(state.rows(), state.registry)


# Index state


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_view(replayed(spark, sf_dir, FULL).rows())


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_view(index_state.latest_rows(index_state.stored(replayed(spark, sf_dir, SMALL).rows())))


def delete_by_doc_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_view(replayed(spark, sf_dir, SMALL).live())


def replace_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_view(replayed(spark, sf_dir, SMALL).live(replace_document=True))


def stale_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = replayed(spark, sf_dir, SMALL)
    return index_view(index_state.stale_chunks(settle(state.rows()), state.deletes))


def deletion_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletions judged against all writes."""
    state = replayed(spark, sf_dir, SMALL)
    writes = index_state.stored(state.rows())
    judged = index_state.deletion_outcomes(state.deletes, state.registry, writes)
    return judged.select("partition", "offset", "doc_id", "index_name", "status", "n_deleted", "success")


def message_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replayed(spark, sf_dir, SMALL).outcomes()
    return found.select("topic", "partition", "offset", "doc_id", "index_name", "status", joined("reason"), "n_chunks")


def outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.outcome_summary(replayed(spark, sf_dir, SMALL).outcomes())


def index_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = replayed(spark, sf_dir, SMALL)
    return index_state.index_stats(state.registry, state.live())


# Streaming


def _streamed(spark: SparkSession, sf_dir: str) -> ChangeLog:
    """All messages through the file source and the streaming ingest, documents in batches of four files; the files go when
    the log has what is in them."""
    configure(spark)
    documents = _through_source(derived.document_messages(spark, sf_dir))
    sources = Sources(
        documents=replace(documents, options={"maxFilesPerTrigger": "4"}),
        deletions=_through_source(derived.deletion_messages(spark, sf_dir)),
        creations=_through_source(derived.creation_messages(spark, sf_dir)),
    )
    out = f"{checkpoint_folder(spark)}/stream-{spark.sql('select uuid()').first()[0]}"
    backfill(spark, sources, f"{out}/index", f"{out}/offsets", SMALL)
    for source in (sources.documents, sources.deletions, sources.creations):
        discard(spark, source.path)
    return ChangeLog(spark, f"{out}/index")


def stream_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_view(_streamed(spark, sf_dir).live())


def redelivered_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in one batch, and those of the documents, conversations' turns and deletions in a second one again."""
    configure(spark)
    documents = spread(derived.document_messages(spark, sf_dir), "partition", "offset")
    deletions = derived.deletion_messages(spark, sf_dir)
    log = ChangeLog(spark, f"{checkpoint_folder(spark)}/redelivered-{spark.sql('select uuid()').first()[0]}")
    prepare(log, SMALL)
    everything = documents.unionByName(deletions).unionByName(derived.creation_messages(spark, sf_dir))
    apply_batch(everything, 0, log, SMALL)
    apply_batch(documents.where("partition <> 1").unionByName(deletions), 1, log, SMALL)
    return index_view(log.live())


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.outcome_summary(_streamed(spark, sf_dir).outcomes())


def compacted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _streamed(spark, sf_dir)
    log.compact()
    return index_view(log.live())


# Search


def analyze_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = docs(spark, sf_dir).select("doc_id", analyze(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id",
        F.size("tokens").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).alias("n_terms"),
        F.md5(F.array_join("tokens", " ").cast("binary")).alias("tokens_md5"),
    )


def _hits(df: DataFrame) -> DataFrame:
    return df.select("query_id", "index_name", "row_id", "score", "rank")


def bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.bm25_search(text_index(spark, sf_dir), benchmark_queries(spark, sf_dir), K))


def bm25_inverted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search from stored postings."""
    index = inverted.build_inverted(text_index(spark, sf_dir))
    return _hits(inverted.inverted_search(index, benchmark_queries(spark, sf_dir), K))


def knn_search_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.knn_search(vector_index(spark, sf_dir), row_queries(spark, sf_dir), K, DIM))


def knn_lsh_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.knn_lsh(lsh_index(spark, sf_dir), row_queries(spark, sf_dir), K, DIM))


def knn_lsh_rows_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = row_queries(spark, sf_dir)
    exact = search.knn_search(vector_index(spark, sf_dir), queries, K, DIM)
    found = search.recall(exact, search.knn_lsh(lsh_index(spark, sf_dir), queries, K, DIM))
    return found.select("query_id", "n_exact", "n_found", F.round("recall", 6).alias("recall"))


def knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx = settle(vector_index(spark, sf_dir))
    return _hits(cells.knn_cells(idx, cells.build_cells(idx, DIM), row_queries(spark, sf_dir), K))


def knn_cells_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx, queries = settle(vector_index(spark, sf_dir)), row_queries(spark, sf_dir)
    found = search.recall(search.knn_search(idx, queries, K, DIM), cells.knn_cells(idx, cells.build_cells(idx, DIM), queries, K))
    return found.select("query_id", "n_exact", "n_found", F.round("recall", 6).alias("recall"))


def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(search.hybrid_search(chunk_index(spark, sf_dir), benchmark_queries(spark, sf_dir), K, DIM))


def hybrid_search_rrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.hybrid_search(
        chunk_index(spark, sf_dir), benchmark_queries(spark, sf_dir), K, DIM, fusion="rrf", depth=2 * K
    )
    return _hits(found)


def filtered_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-text search over first chunks outside English."""
    some = search.filter_index(text_index(spark, sf_dir), lang=["fr", "de", "es"], chunk_id=(None, 0))
    return _hits(search.bm25_search(some, benchmark_queries(spark, sf_dir), K))


def lookup_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of every toxic document, looked up by the pairs that deletions name."""
    state = replayed(spark, sf_dir, SMALL)
    rows = index_state.latest_rows(index_state.stored(state.rows()))
    return search.lookup_docs(rows, state.deletes).select("index_name", "row_id", "n_words", text_md5())


def point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the last conversation, read from the stored log."""
    last = table(spark, sf_dir, "conversations").agg(F.max("conv_id")).first()[0]
    rows = _streamed(spark, sf_dir).documents("user_chat_topic", [f"conv-{last}"])
    return rows.select("index_name", "row_id", "n_words", text_md5())


def lookup_one_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of the last conversation."""
    state = replayed(spark, sf_dir, SMALL)
    rows = index_state.latest_rows(index_state.stored(state.rows()))
    last = table(spark, sf_dir, "conversations").agg(F.max("conv_id")).first()[0]
    return search.lookup_doc(rows, "user_chat_topic", f"conv-{last}").select("index_name", "row_id", "n_words", text_md5())


def index_head_of_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of the first index."""
    rows = text_index(spark, sf_dir).select("index_name", "row_id", "text")
    first = rows.agg(F.min("index_name")).first()[0]
    return search.index_head(rows, first, K).select("index_name", "row_id", text_md5())


def index_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text_index(spark, sf_dir).select("index_name", "row_id", "text")
    return search.index_heads(rows, K).select("index_name", "row_id", text_md5(), "position")


QUERIES = {
    "src_documents": src_documents,
    "src_deletions": src_deletions,
    "src_index_creations": src_index_creations,
    "decode_messages": decode_messages,
    "validate_documents": validated_documents,
    "validate_user_scope": validated_user_scope,
    "validate_deletions": validated_deletions,
    "validate_index_creations": validated_creations,
    "topic_type": topic_types,
    "parse_upload_time": upload_times,
    "create_indices": created_indices,
    "system_indices": system_indices,
    "system_indices_ready": system_indices_ready,
    "route_existing": route_existing,
    "route_missing": route_missing,
    "chunk_documents": chunk_documents,
    "chunk_documents_small": chunk_documents_small,
    "split_sentences": split_sentences,
    "word_counts": word_counts,
    "long_sentence_windows": long_sentence_windows,
    "chunk_overlap_check": chunk_overlap_check,
    "chunks_per_document": chunks_per_document,
    "empty_documents": empty_documents,
    "chunk_embeddings": chunk_embeddings,
    "hash_embed": hash_embed,
    "embedding_batches": embedding_batches,
    "order_by_index": order_by_index,
    "embedding_dim_check": embedding_dim_check,
    "index_outcomes": index_outcomes,
    "dim_report": dim_report,
    "index_rows": index_rows,
    "upsert_latest": upsert_latest,
    "delete_by_doc_id": delete_by_doc_id,
    "replace_document": replace_document,
    "stale_chunks": stale_chunks,
    "deletion_outcomes": deletion_outcomes,
    "message_outcomes": message_outcomes,
    "outcome_summary": outcome_summary,
    "index_stats": index_stats,
    "stream_backfill": stream_backfill,
    "redelivered_index": redelivered_index,
    "stream_outcomes": stream_outcomes,
    "compacted_index": compacted_index,
    "analyze_tokens": analyze_tokens,
    "bm25_search": bm25_search,
    "bm25_inverted": bm25_inverted,
    "knn_search": knn_search_rows,
    "knn_lsh": knn_lsh_rows,
    "knn_lsh_recall": knn_lsh_rows_recall,
    "knn_cells": knn_cells,
    "knn_cells_recall": knn_cells_recall,
    "knn_search_rows": knn_search_rows,
    "knn_lsh_rows": knn_lsh_rows,
    "knn_lsh_rows_recall": knn_lsh_rows_recall,
    "hybrid_search": hybrid_search,
    "hybrid_search_rrf": hybrid_search_rrf,
    "filtered_search": filtered_search,
    "lookup_doc": lookup_docs,
    "lookup_one_doc": lookup_one_doc,
    "point_read": point_read,
    "index_head_of_one": index_head_of_one,
    "index_head": index_head,
}
