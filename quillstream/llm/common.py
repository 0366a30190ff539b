"""Helpers the operators share: reading tables, keys of rows, filters by decision, words of bytes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillstream.plans.sizing import measure, spread
from quillstream.session import configure, settle

# A side of a join is broadcast only after it was measured to be below this; else the join shuffles.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, dealt out to all cores if it is one small file."""
    configure(spark)
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"), *{"documents": ["doc_id"]}.get(name, []))


def small(df: DataFrame) -> DataFrame:
    """Mark a settled table for broadcast if its exact size is below the limit."""
    return F.broadcast(df) if measure(df)[1] <= BROADCAST_BYTES else df


def text_of(df: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The two columns an operator reads, by fixed names whatever else the table holds; null text is empty."""
    return df.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )


def row_key(id_column: str = "doc_id") -> Column:
    """Tells rows apart that repeat a doc_id with another text; null and empty text differ. Texts of 64 equal bits and one doc_id do not occur by chance."""
    text = F.col("text")
    return F.concat_ws(":", F.col(id_column).cast("string"), F.hex(F.xxhash64(text, text.isNull())))


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is in `kept(row_key)`, with the columns of `docs`; rows are neither doubled nor reordered.

    Texts are shuffled only if the kept keys were measured to be too many for a broadcast.
    """
    name = "__row_key"
    keys = small(kept.select(F.col("row_key").alias(name)))
    return docs.withColumn(name, row_key()).join(keys, name, "left_semi").select(*docs.columns)


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of `docs` whose key is not in `dropped(row_key)`."""
    name = "__row_key"
    keys = small(dropped.select(F.col("row_key").alias(name)))
    return docs.withColumn(name, row_key()).join(keys, name, "left_anti").select(*docs.columns)


def one_of_repeated(docs: DataFrame, staying: DataFrame, repeated: DataFrame) -> DataFrame:
    """`staying` with one row for each settled key `repeated(row_key)`; such rows of `docs` differ in other columns at most."""
    if repeated.isEmpty():
        return staying
    one_each = keep_rows(docs, repeated).withColumn("__row_key", row_key()).dropDuplicates(["__row_key"]).drop("__row_key")
    return drop_rows(staying, repeated).unionByName(one_each)


def ints(values: Any) -> pa.Array:
    return pa.array(values, pa.int64())


def rows_of(batches: Iterator[pa.RecordBatch], piece: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about `piece` bytes of text (one row at least), to bound what a task holds."""
    for batch in batches:
        if batch.nbytes <= piece or batch.num_rows < 2:
            yield batch
            continue
        step = max(1, batch.num_rows * piece // batch.nbytes)
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def cut(data: bytes, size: int, ends: bytes = b" ") -> Iterator[bytes]:
    """Slices of about `size` bytes that end at one of the bytes in `ends`, so that no word is cut."""
    start, n = 0, len(data)
    while n - start > size:
        found = max(data.rfind(bytes([end]), start, start + size) for end in ends)
        if found < 0:  # a word longer than the slice stays whole
            found = min((at for end in ends if (at := data.find(bytes([end]), start + size)) >= 0), default=n - 1)
        yield data[start : found + 1]
        start = found + 1
    yield data[start:]


def join_unique(rows: DataFrame, side: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """Left join of `rows` with a settled `side` that has a key at most once, safe against keys that many rows have.

    Keys with over one in `share` of all rows are fewer than `share`, so their rows of `side` are broadcast; rows with a
    null key are joined with nothing. If all of `side` was measured to be small, it is broadcast as a whole.
    """
    if measure(side)[1] <= BROADCAST_BYTES:
        return rows.join(F.broadcast(side), key, "left")
    n = rows.count()
    heavy = settle(rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * share > n).select(key))
    common = side.join(F.broadcast(heavy), key, "left_semi")
    flagged = rows.join(F.broadcast(heavy.withColumn("_heavy", F.lit(True))), key, "left")
    alone = F.col("_heavy").isNotNull() | F.col(key).isNull()
    most = flagged.where(alone).drop("_heavy").join(F.broadcast(common), key, "left")
    rest = flagged.where(~alone).drop("_heavy").join(side.join(F.broadcast(heavy), key, "left_anti"), key, "left")
    return most.unionByName(rest.select(*most.columns))
