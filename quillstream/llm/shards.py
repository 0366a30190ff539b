"""Operator 12: documents in random order, dealt to shards, by a two-pass external shuffle.

Pass one scatters rows into buckets by a seeded hash. A bucket holds `BUCKET_BYTES` of the source on average, so it fits into
memory whatever the size of the table. Pass two reads one bucket at a time, puts its rows into a fixed order, shuffles them by
Fisher-Yates with a generator seeded by the bucket, and writes them as Parquet files sorted by bucket and place.

The buckets one after the other are the shuffled table; shard s of S is its s-th part, so numbers of rows differ by one at most
(law `rows`). A manifest of buckets (rows, rows before) turns bucket and place into shard and slot. It is small beside the
table, one row for each bucket, and its running sum is made in blocks, so that no task has to read all of it.

The hash is of all columns and of the partition a row is read in. Rows that are alike in all columns may lie in one bucket only
as far as one input partition held them, so the rows of one bucket never depend on how often a row repeats in the table. It is
a function of the row and its partition only: a task that runs again scatters the same rows to the same buckets. The rows and
the manifest are read from the written files, so a lost executor changes neither. The same seed over the same files gives the
same shards.

Cases: null text is kept as null and counts no bytes; rows that repeat stay apart, each with a slot of its own; doc_id is no
key here and may be null; a text of any length lies in one bucket, which it may fill alone; all columns are kept, below `doc`,
so none can clash; fewer rows than shards leave shards empty; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from quillstream.plans.sizing import source_bytes
from quillstream.session import settle

from .common import small

SEED, SHARDS = 20, 8
BUCKET_BYTES = 16 << 20  # of source
SLICE_BYTES = 4 << 20  # that pass two hands on at once
BLOCK = 4096  # buckets whose running sum one task makes


def fisher_yates(n: int, generator: np.random.Generator) -> np.ndarray:
    """A random order of n things, every one equally likely."""
    order = list(range(n))
    draws = generator.integers(0, np.arange(1, n + 1)).tolist() if n else []
    for last in range(n - 1, 0, -1):
        other = draws[last]
        order[last], order[other] = order[other], order[last]
    return np.array(order, np.int64)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def scatter(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Pass one: `bucket`, `mix` (the hash) and `doc` (all columns), each bucket in one partition, its rows in the order of the hash."""
    named = [F.col(f"`{field.name}`") for field in docs.schema.fields if _hashable(field.dataType)]
    mix = F.xxhash64(F.lit(seed), F.spark_partition_id(), *named)
    mixed = docs.select(mix.alias("mix"), F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"))
    dealt = mixed.select(F.pmod(F.xxhash64(F.col("mix")), F.lit(buckets)).cast("int").alias("bucket"), "mix", "doc")
    return dealt.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "mix")


def shuffle_buckets(scattered: DataFrame, seed: int) -> DataFrame:
    """Pass two: rows of each bucket in random order, with their `place` in it."""
    schema = T.StructType([scattered.schema["bucket"], T.StructField("place", T.IntegerType()), scattered.schema["doc"]])

    def shuffled(bucket: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_arrays([batch.column("doc") for batch in batches])
        batches.clear()
        order = fisher_yates(len(rows), np.random.default_rng([seed, bucket]))
        step = max(1, len(rows) * SLICE_BYTES // max(1, rows.nbytes))
        for start in range(0, len(rows), step):
            taken = rows.take(pa.array(order[start : start + step]))
            places = pa.array(np.arange(start, start + len(taken)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * len(taken), pa.int32()), places, taken], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = -1, []
        for batch in batches:
            numbers = batch.column("bucket").to_numpy()
            starts = np.flatnonzero(np.diff(numbers, prepend=-1)).tolist()
            for start, stop in zip(starts, [*starts[1:], len(numbers)]):
                if numbers[start] != now and waiting:
                    yield from shuffled(now, waiting)
                now = int(numbers[start])
                waiting.append(batch.slice(start, stop - start))
        if waiting:
            yield from shuffled(now, waiting)

    return scattered.mapInArrow(run, schema)


def shuffled_table(docs: DataFrame, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """`bucket`, `place` and `doc` of all rows, written in this order."""
    size, buckets = source_bytes(docs), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size < 1 << 60:  # else the source has no statistics
        buckets = max(buckets, -(-size // bucket_bytes))
    return settle(shuffle_buckets(scatter(docs, buckets, seed), seed))


def bucket_manifest(rows: DataFrame) -> DataFrame:
    """Rows of each bucket, rows of all buckets before it, and of all."""
    counts = settle(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.floor(F.col("bucket") / BLOCK)))
    within = Window.partitionBy("block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("block").agg(F.sum("n").alias("size"))  # one row for `BLOCK` buckets
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = blocks.select("block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"), F.sum("size").over(Window.partitionBy()).alias("total"))
    before = F.col("base") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return counts.join(F.broadcast(bases), "block").select("bucket", "n", before.alias("before"), "total")


def dealt(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """`doc`, `shard` and `slot` of the rows of a shuffled table."""
    place = F.col("before") + F.col("place")
    shard = F.expr(f"cast((before + place) * {shards} div total as int)")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    placed = rows.join(small(settle(bucket_manifest(rows))), "bucket").select("doc", place.alias("at"), "total", shard.alias("shard"))
    return placed.select("doc", "shard", (F.col("at") - first).alias("slot"))


def read_shard(rows: DataFrame, manifest: DataFrame, shard: int, shards: int = SHARDS) -> DataFrame:
    """Rows of one shard in order, of the buckets that it has a part of; file statistics skip the others."""
    low, high = F.expr(f"({shard} * total + {shards - 1}) div {shards}"), F.expr(f"({shard + 1} * total + {shards - 1}) div {shards}")
    parts = manifest.withColumn("low", low).withColumn("high", high).where("before < high and before + n > low")
    ends = parts.agg(F.min("bucket"), F.max("bucket")).first()
    if ends[0] is None:
        return rows.select("doc.*").limit(0)
    some = rows.where(F.col("bucket").between(*ends)).join(small(parts), "bucket")
    at = F.col("before") + F.col("place")
    return some.where((at >= F.col("low")) & (at < F.col("high"))).orderBy("bucket", "place").select("doc.*")


def shard_report(docs: DataFrame) -> DataFrame:
    """One row for each document, of what was written: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    return dealt(shuffled_table(docs)).select(
        F.col("doc.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
