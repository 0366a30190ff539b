"""Operator 3: exact duplicates by composable polynomial fingerprints and chunkwise comparison.

Texts are equal when identical after lower-casing A-Z. A text is cut into chunks of bytes; each chunk is hashed on its
own as a polynomial modulo two primes, all chunks of a text by one matrix product, and the hashes of neighbours combine to
that of both by `combine`: shift the left one by the length of the right one, add. Rows of equal fingerprints are only
candidates: each is compared with the row of its group that would stay, chunk by chunk, by a join on (group, chunk
number) that never holds two whole texts. Rows that differ from it go into another round among themselves.

Of equal texts the row with the largest doc_id stays; of rows that repeat this doc_id too, one.

Cases: null text equals empty text; a null doc_id is smaller than any other; repeated rows are copies of each other; an
empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillstream.functions.arrow import expand
from quillstream.session import settle

from .common import drop_rows, ints, one_of_repeated, row_key, rows_of, small

CHUNK_BYTES = 4096  # of a hash: 255 * 2**31 * 4096 is exact in a double
COMPARED_BYTES = 64 << 10  # of a comparison
PRIMES = (2**31 - 1, 2**31 - 19)
BASES = (1_103_515_245, 1_664_525)
ROWS_PER_SALT = 2000  # rows of one group that are compared by one task


def combine(left: tuple[int, int], right: tuple[int, int], right_length: int) -> tuple[int, int]:
    """Fingerprint of a text from those of its two parts."""
    return tuple((a * pow(base, right_length, p) + b) % p for a, b, base, p in zip(left, right, BASES, PRIMES))


def powers(length: int) -> np.ndarray:
    """Weights of the bytes of a chunk, one column for each prime."""
    out = np.empty((length, len(PRIMES)))
    for column, (base, prime) in enumerate(zip(BASES, PRIMES)):
        value = 1
        for at in range(length - 1, -1, -1):
            out[at, column] = value
            value = value * base % prime
    return out


def chunk_hashes(data: bytes, weights: np.ndarray) -> tuple[np.ndarray, int]:
    """Hashes of all chunks, and the length of the first one; the others are full."""
    size = len(weights)
    first = len(data) % size
    padded = np.zeros(len(data) + (size - first) % size, dtype=np.uint8)
    padded[len(padded) - len(data) :] = np.frombuffer(data, dtype=np.uint8)  # leading zeros add nothing
    hashes = np.empty((len(padded) // size, len(PRIMES)), dtype=np.int64)
    for start in range(0, len(hashes), 256):
        block = padded[start * size : (start + 256) * size].reshape(-1, size).astype(np.float64)
        hashes[start : start + 256] = (block @ weights).astype(np.int64)
    return hashes % np.array(PRIMES), first


def fingerprint(data: bytes, weights: np.ndarray) -> tuple[int, int]:
    hashes, _ = chunk_hashes(data, weights)
    parts = [tuple(row) for row in hashes.tolist()]
    return reduce(lambda left, right: combine(left, right, len(weights)), parts, (0, 0))


def normalised(text: str) -> bytes:
    return text.encode().lower()  # of bytes, so A-Z only


def fingerprints(docs: DataFrame, hash_of: Callable = fingerprint) -> DataFrame:
    """row_key, doc_id, text_sha256, and the fingerprint `fp` (two hashes in one number) with `n_bytes`, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = powers(CHUNK_BYTES)
        for batch in rows_of(batches):
            columns: tuple[list, ...] = ([], [], [])
            for text in batch.column(2):
                data = normalised(text.as_py())
                a, b = hash_of(data, weights)
                columns[0].append(hashlib.sha256(data).hexdigest())
                columns[1].append(a << 31 | b)
                columns[2].append(len(data))
            arrays = [batch.column(0), batch.column(1), pa.array(columns[0], pa.string()), ints(columns[1]), ints(columns[2])]
            yield pa.RecordBatch.from_arrays(arrays, names=["row_key", "doc_id", "text_sha256", "fp", "n_bytes"])

    keyed = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return keyed.mapInArrow(run, "row_key string, doc_id bigint, text_sha256 string, fp bigint, n_bytes bigint")


def _chunks(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Chunks of the texts of wanted(row_key, first_key, salt, is_first); a text without bytes has one chunk too."""
    kept = ["row_key", "first_key", "salt", "is_first"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            rows, numbers, parts = [], [], []
            for row, text in enumerate(batch.column("text")):
                data = normalised(text.as_py())
                for at in range(0, max(1, len(data)), COMPARED_BYTES):
                    rows.append(row)
                    numbers.append(at // COMPARED_BYTES)
                    parts.append(data[at : at + COMPARED_BYTES])
            yield expand(batch, kept, rows, {"chunk": ints(numbers), "part": pa.array(parts, pa.binary())})

    keyed = docs.select(row_key().alias("row_key"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "row_key string, first_key string, salt bigint, is_first boolean, chunk bigint, part binary"
    return keyed.join(small(wanted), "row_key").select(*kept, "text").mapInArrow(run, schema)


def _same_as_first(docs: DataFrame, members: DataFrame) -> DataFrame:
    """row_key of the members(row_key, first_key, salt) whose text is that of their group's first, by comparing chunks.

    The first one's chunks go to each salt of its group, so members of one group are compared in many tasks; each chunk is
    shuffled once.
    """
    own = members.select("row_key", "first_key", "salt", F.lit(False).alias("is_first"))
    firsts = members.select("first_key", "salt").distinct()
    wanted = settle(own.union(firsts.select(F.col("first_key").alias("row_key"), "first_key", "salt", F.lit(True))))
    chunks = settle(_chunks(docs, wanted))
    at = ["first_key", "salt", "chunk"]
    theirs = chunks.filter("is_first").groupBy(*at).agg(F.first("part").alias("first_part"))
    compared = chunks.filter("not is_first").join(theirs, at, "left")
    return compared.groupBy("row_key").agg(F.min(F.coalesce(F.col("part") == F.col("first_part"), F.lit(False))).alias("same")).filter("same")


def _spread_salt(size: Column) -> Column:
    return F.pmod(F.xxhash64("row_key"), F.greatest(F.lit(1), (size / ROWS_PER_SALT).cast("bigint")))


def exact_classes(docs: DataFrame, hash_of: Callable = fingerprint) -> DataFrame:
    """One row for each row of `docs`: row_key, doc_id, text_sha256, keep_id, group_size and `kept`; settled.

    Rows that repeat doc_id and text share a key; one of them at most has `kept`. `hash_of(bytes, weights)` gives the two
    hashes of a text; any function gives the same classes, a poor one in more rounds.
    """
    rows = settle(fingerprints(docs, hash_of).withColumn("tag", F.monotonically_increasing_id()))
    # rows that repeat doc_id and text are one text to compare
    texts = rows.groupBy("fp", "n_bytes", "row_key").agg(F.max("doc_id").alias("doc_id"))
    left, classes = settle(texts), None
    while True:
        groups = settle(
            left.groupBy("fp", "n_bytes").agg(F.max(F.struct("doc_id", "row_key")).alias("first"), F.count(F.lit(1)).alias("texts"))
            .select("fp", "n_bytes", F.col("first.row_key").alias("first_key"), "texts").filter("texts > 1")
        )
        members = settle(
            left.join(groups, ["fp", "n_bytes"]).filter("row_key <> first_key")
            .select("fp", "n_bytes", "row_key", "doc_id", "first_key", _spread_salt(F.col("texts")).alias("salt"))
        )
        if members.isEmpty():
            break
        same = settle(_same_as_first(docs, members).select("row_key"))
        found = members.join(same, "row_key", "left_semi").select("row_key", "first_key")
        classes = found if classes is None else classes.union(found)
        left = settle(members.join(same, "row_key", "left_anti").select("fp", "n_bytes", "row_key", "doc_id"))
        if left.isEmpty():
            break
    if classes is None:
        named = rows.withColumn("first_key", F.col("row_key"))
    else:
        named = rows.join(settle(classes), "row_key", "left").withColumn("first_key", F.coalesce("first_key", "row_key"))
    named = settle(named)
    sizes = named.groupBy("first_key").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "tag")).alias("best")
    )
    joined = named.join(sizes, "first_key")
    return settle(
        joined.select(
            "row_key", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
            (F.col("tag") == F.col("best.tag")).alias("kept"), "text_sha256",
        )
    )


def exact_duplicates(docs: DataFrame, hash_of: Callable = fingerprint) -> DataFrame:
    """One row for each document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    return exact_classes(docs, hash_of).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """Rows that stay, with the columns of `docs`."""
    keys = settle(exact_classes(docs).groupBy("row_key").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")))
    staying = drop_rows(docs, keys.filter("not kept"))
    # of rows that repeat doc_id and text one is taken; the rest need no shuffle
    return one_of_repeated(docs, staying, settle(keys.filter("kept and rows > 1").select("row_key")))
