"""The index as a change log and the view of it: upserts by row, deletes by document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ids import index_kind, row_id
from ..plans.sizing import BROADCAST_BYTES, broadcast_if_small, measure
from ..schemas import INDEX_ROW
from ..session import settle

DOC_KEY = ["index_name", "doc_id"]
# Of the number of a row in its file, the bits that are its place in a bitmap: as many as `bitmap_construct_agg` takes.
PLACE_BITS = 15


def to_index_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Chunk rows in the shape of the index: system indices keep `upload_time`, others `user_id` and `user_upload_time`.

    `keep` names further columns to hand on.
    """
    system = index_kind(F.col("index_name")) == "system"
    shaped = rows.select(
        "index_name",
        row_id(F.col("doc_id"), F.col("chunk_id")).alias("row_id"),
        "doc_id",
        "chunk_id",
        "text",
        "n_words",
        "source_type",
        "document_url",
        F.when(~system, F.col("user_id")).alias("user_id"),
        F.when(system, F.col("upload_time")).alias("upload_time"),
        F.when(~system, F.col("upload_time")).alias("user_upload_time"),
        "upload_time_raw",
        "embedding",
        "error",
        "arrival",
        F.create_map().cast("map<string,string>").alias("metadata"),
        *keep,
    )
    return shaped.select(*[F.col(f.name).cast(f.dataType) for f in INDEX_ROW.fields], *keep)


def stored(log: DataFrame) -> DataFrame:
    """Log rows that the index took: no marker rows, no failed rows."""
    return log.where(F.col("chunk_id").isNotNull() & F.col("error").isNull())


def _write_order(log: DataFrame) -> list[str]:
    """What orders writes of one row; a message that came again has the same arrival, but in a stored log a later batch."""
    return [name for name in ("arrival", "batch_id") if name in log.columns]


def latest_rows(log: DataFrame) -> DataFrame:
    """The last write of each row; of the same message delivered again, one.

    Spark limits each (index, row) group to one row before the shuffle as well as after it, so a row that was
    written very often sends at most one version per task.
    """
    newest_first = Window.partitionBy("index_name", "row_id").orderBy(*[F.desc(name) for name in _write_order(log)])
    return log.withColumn("_n", F.row_number().over(newest_first)).where("_n = 1").drop("_n")


def overwritten(log: DataFrame) -> DataFrame:
    """Rows written more than once, with their last write `_last` and how many rows are that write (`_same`, over 1 if a
    message came twice in one batch); reads keys only, no text and no vector."""
    key = ["index_name", "row_id"]
    writes = log.select(*key, F.struct(*_write_order(log)).alias("_write")).groupBy(*key, "_write").agg(F.count(F.lit(1)).alias("_n"))
    return (
        writes.groupBy(*key)
        .agg(F.max("_write").alias("_last"), F.max_by("_n", "_write").alias("_same"), F.sum("_n").alias("_all"))
        .where("_all > 1")
        .drop("_all")
    )


def latest_stored_rows(log: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The same as `latest_rows`, for a log that is a stored table and can be read twice.

    While few rows have been overwritten, their keys are broadcast, and texts and vectors are not shuffled at all, but
    for rows whose last write is there more than once: of these one is taken.
    """
    again = settle(overwritten(log))
    if measure(again)[1] > limit:
        return latest_rows(log)
    marked = log.join(F.broadcast(again), ["index_name", "row_id"], "left")
    last = marked.where(F.col("_last").isNull() | (F.struct(*_write_order(log)) == F.col("_last")))
    if again.where("_same > 1").isEmpty():
        return last.select(*log.columns)
    repeated = F.coalesce(F.col("_same") > 1, F.lit(False))
    return last.where(~repeated).select(*log.columns).unionByName(latest_rows(last.where(repeated).select(*log.columns)))


def last_deletes(deletes: DataFrame) -> DataFrame:
    return deletes.groupBy(*DOC_KEY).agg(F.max("arrival").alias("_deleted"))


def apply_deletes(rows: DataFrame, deletes: DataFrame) -> DataFrame:
    """Drop rows that are older than a deletion of exactly their doc_id in their index."""
    last = broadcast_if_small(settle(last_deletes(deletes)))
    return (
        rows.join(last, DOC_KEY, "left")
        .where(F.col("_deleted").isNull() | (F.col("arrival") > F.col("_deleted")))
        .select(*rows.columns)
    )


def with_place(stored_table: DataFrame) -> DataFrame:
    """Rows of a stored table with the file that they lie in, `_file`, and their number in it, `_at`."""
    return stored_table.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))


def _block_and_bit() -> tuple[Column, Column]:
    return F.shiftright("_at", PLACE_BITS), F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1)


def live_places(log: DataFrame, deletes: DataFrame) -> DataFrame:
    """Where the live rows of a log lie (`with_place`): a bitmap `_alive` for each block of a file that has any. Keys and
    places only are shuffled, no text and no vector, and of a row that was written very often one a task."""
    keys = log.select(*DOC_KEY, "row_id", *_write_order(log), "_file", "_at")
    alive = apply_deletes(latest_rows(keys), deletes)
    block, bit = _block_and_bit()
    return alive.groupBy("_file", block.alias("_block")).agg(F.bitmap_construct_agg(bit).alias("_alive"))


def live_stored_rows(log: DataFrame, deletes: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The same as `apply_deletes` of `latest_rows`, for a log that is a stored table and can be read twice, `with_place`.

    Of a first reading, of keys, one bit a row is left, which is broadcast; in the second, rows are taken or dropped where they
    are read. So however many rows were overwritten or deleted, texts and vectors are not shuffled.
    """
    places = settle(live_places(log, deletes))
    if measure(places)[1] > limit:
        return apply_deletes(latest_stored_rows(log), deletes)
    block, bit = _block_and_bit()
    byte = F.conv(F.hex(F.substr("_alive", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = log.withColumn("_block", block).join(F.broadcast(places), ["_file", "_block"])
    return marked.where(F.getbit(byte, bit.bitwiseAND(7).cast("int")) == 1).select(*log.columns)


def rewritten(log: DataFrame) -> DataFrame:
    """Documents with writes of different arrival, and the last of these; reads keys only, and hot documents are combined
    before the shuffle."""
    writes = log.groupBy(*DOC_KEY).agg(F.min("arrival").alias("_first"), F.max("arrival").alias("_written"))
    return writes.where("_first <> _written").drop("_first")


def of_last_version(live: DataFrame, log: DataFrame, stale: bool = False) -> DataFrame:
    """Rows of `live` that the last write of their document made, or those that it did not.

    Only documents that were written more than once are looked for; while they are few, no row is shuffled.
    """
    marked = live.join(broadcast_if_small(settle(rewritten(log))), DOC_KEY, "left")
    fresh = F.col("_written").isNull() | (F.col("arrival") == F.col("_written"))
    return marked.where(~fresh if stale else fresh).select(*live.columns)


def live_rows(log: DataFrame, deletes: DataFrame, replace_document: bool = False) -> DataFrame:
    """The index as it stands.

    A document that comes again with fewer chunks leaves its old tail, unless `replace_document` is set.
    """
    taken = stored(log)
    live = apply_deletes(latest_rows(taken), deletes)
    return of_last_version(live, taken) if replace_document else live


def stale_chunks(log: DataFrame, deletes: DataFrame) -> DataFrame:
    """Live rows left over from an older version of their document."""
    taken = stored(log)
    return of_last_version(apply_deletes(latest_rows(taken), deletes), taken, stale=True)


def deleted_rows(deletes: DataFrame, writes: DataFrame) -> DataFrame:
    """Rows that each deletion took out: `index_name, doc_id, arrival, n_deleted`, for deletions that took any.

    A write belongs to the first deletion of its document after it; a deletion counts the distinct rows of its writes.
    Needs keys only. The deletions of a document are one sorted list, so a document with many writes is a skewed join
    that Spark splits, and its writes are combined before each shuffle.
    """
    lists = deletes.groupBy(*DOC_KEY).agg(F.array_sort(F.collect_set("arrival")).alias("_deletions"))
    keys = writes.select(*DOC_KEY, "row_id", F.col("arrival").alias("_written"))
    after = F.filter("_deletions", lambda deletion: deletion > F.col("_written"))
    taken = keys.join(broadcast_if_small(settle(lists)), DOC_KEY).select(*DOC_KEY, "row_id", F.array_min(after).alias("arrival"))
    rows = taken.where(F.col("arrival").isNotNull()).groupBy(*DOC_KEY, "arrival", "row_id").agg(F.lit(1).alias("_one"))
    return rows.groupBy(*DOC_KEY, "arrival").agg(F.count(F.lit(1)).alias("n_deleted"))


def deletion_outcomes(deletes: DataFrame, registry: DataFrame, writes: DataFrame) -> DataFrame:
    """What each valid deletion did, given all stored `writes` (keys are enough).

    `missing_index` if its index had not been made, `deleted` with the number of rows, or `nothing_found`, which counts
    as success.
    """
    made = broadcast_if_small(registry.select("index_name", F.col("created").alias("_created")))
    judged = deletes.join(made, "index_name", "left").withColumn("_known", F.coalesce(F.col("_created") < F.col("arrival"), F.lit(False)))
    hits = deleted_rows(judged.where("_known"), writes)
    counted = judged.join(hits, [*DOC_KEY, "arrival"], "left").withColumn("n_deleted", F.coalesce("n_deleted", F.lit(0)).cast("bigint"))
    status = (
        F.when(~F.col("_known"), F.lit("missing_index"))
        .when(F.col("n_deleted") > 0, F.lit("deleted"))
        .otherwise(F.lit("nothing_found"))
    )
    return counted.select(
        *deletes.columns, status.alias("status"), "n_deleted", F.col("_known").alias("success")
    )


def index_outcomes(rows: DataFrame, key: tuple[str, ...] = ("index_name", "doc_id")) -> DataFrame:
    """Stored and failed rows by document; a document counts as indexed when any row was stored."""
    ok = F.col("chunk_id").isNotNull() & F.col("error").isNull()
    return (
        rows.groupBy(*key)
        .agg(F.count_if(ok).alias("n_ok"), F.count_if(~ok).alias("n_failed"))
        .withColumn("success", F.col("n_ok") > 0)
    )


def index_stats(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """Every index with its number of rows and documents; an index that never got a document shows 0."""
    per_document = rows.groupBy(*DOC_KEY).agg(F.count(F.lit(1)).alias("n"))
    counts = per_document.groupBy("index_name").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_docs"))
    return registry.select("index_name", "kind").join(counts, "index_name", "left").na.fill(0, ["n_rows", "n_docs"])
