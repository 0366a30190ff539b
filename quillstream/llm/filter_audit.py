"""Operator 13: how filters of documents interact, by sorted posting lists.

For each part (a source) and range of row ids there is one sorted list of failing ids for each filter, and one for each
label. What a filter removes after a set of others is the difference of its list and the union of theirs, so the five
filters need 80 differences for all their 120 orders. Unions and differences are made by galloping: a run of ids steps
through the other list in doubled strides to the window that can hold it, and is searched for in that window only. The
sizes are sums over ranges.

Row ids are given where the documents are read, so a range holds at most 2 ** `RANGE_BITS` rows of one part, however large the part
is. Of the documents only numbers and a digest of the text are handed on.

Failing the copy filter means that a row of smaller doc_id has an equal text; texts are equal when their SHA-256 is. Texts
that over a thousandth of all rows share are fewer than a thousand; their smallest doc_id is broadcast, and the rows of the
others are joined in a shuffle.

Cases: null text is empty (no words: it fails A only, and E if another row of smaller doc_id has no text); a row with a null
doc_id fails E never and has no label; rows that repeat a doc_id count each, share its labels and are no copies of each other;
of several labels of one doc_id any that is 1 counts; a null source is the part ''; an empty table has no parts; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillstream.session import settle

from .common import cut, ints, join_unique, rows_of

FILTERS = "ABCDE"
RANGE_BITS = 16
STRIDE = 256  # ids that gallop together
SLICE_BYTES = 1 << 20
SPACES = b" \t\n\v\f\r"
UPPER = bytes(range(65, 91))
SIGNS = b"#$%&*|"

LISTS = [*FILTERS, "good", "toxic"]
SIZES = ["n", "gone", "removed", "fails", "only", "good", "toxic"]
ROWS = "row_id bigint, doc_id bigint, part string, failed int, digest binary"


def word_counts(data: bytes) -> tuple[int, int]:
    """Words and different words; a long text is split slice by slice."""
    if len(data) <= SLICE_BYTES:
        words = data.split()
        return len(words), len(set(words))
    total, different = 0, set()
    for piece in cut(data, SLICE_BYTES, SPACES):
        words = piece.split()
        total += len(words)
        different.update(words)
    return total, len(different)


def failures(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    data = text.encode()
    n, different = word_counts(data)
    capitals = len(data) - len(data.translate(None, UPPER))
    signs = len(data) != len(data.translate(None, SIGNS))
    return (n < 50) | (100 * different < 65 * n) << 1 | (100 * capitals > 5 * len(text)) << 2 | signs << 3


def judged(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, part, failed (bits A to D) and digest of each row; settled, as row ids are only kept when written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = batch.column("text").to_pylist()
            digests = [hashlib.sha256(text.encode()).digest() for text in texts]
            columns = [batch.column("row_id"), batch.column("doc_id"), batch.column("part")]
            columns += [pa.array([failures(text) for text in texts], pa.int32()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "doc_id", "part", "failed", "digest"])

    read = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return settle(read.mapInArrow(run, ROWS))


def postings(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part and range of row ids: its number of rows and the sorted lists of ids, `A` to `E`, `good`, `toxic`."""
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = marks.agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = join_unique(rows, settle(marks.where("good or toxic")), "doc_id")
    copied = settle(marked.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    whole = join_unique(marked, copied, "digest")
    holds = {name: F.col("failed").bitwiseAND(1 << bit) != 0 for bit, name in enumerate("ABCD")}
    holds |= {"E": F.col("doc_id") > F.col("least"), "good": F.col("good"), "toxic": F.col("toxic")}
    lists = [F.array_sort(F.collect_list(F.when(holds[name], F.col("row_id")))).alias(name) for name in LISTS]
    ranges = F.shiftright("row_id", RANGE_BITS).alias("ids")
    return whole.groupBy("part", ranges).agg(F.count(F.lit(1)).alias("n"), *lists)


def _stride(hay: np.ndarray, low: int, bound: int) -> tuple[int, int]:
    """Window of the hay, from `low` on, in which `bound` lies; its ends are found in doubled steps."""
    high, step = low, 1
    while high < len(hay) and hay[high] < bound:
        low, high, step = high, high + step, 2 * step
    return low, min(high, len(hay))


def gallop(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Place of each needle in the hay, both sorted: where it is or would be inserted."""
    places, low = np.empty(len(needles), np.int64), 0
    for start in range(0, len(needles), STRIDE):
        some = needles[start : start + STRIDE]
        low, _ = _stride(hay, low, some[0])
        _, high = _stride(hay, low, some[-1])
        places[start : start + STRIDE] = low + np.searchsorted(hay[low:high], some)
    return places


def held(needles: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Whether each needle is in the hay."""
    if not len(hay):
        return np.zeros(len(needles), bool)
    places = gallop(needles, hay)
    return hay[np.minimum(places, len(hay) - 1)] == needles


def difference(ids: np.ndarray, others: np.ndarray) -> np.ndarray:
    return ids[~held(ids, others)]


def union(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Merge of two lists: what only the shorter has is put into the longer."""
    short, long = (one, two) if len(one) < len(two) else (two, one)
    new = difference(short, long)
    return np.insert(long, gallop(new, long), new)


def interactions(n: int, lists: dict[str, np.ndarray]) -> Iterator[tuple]:
    """For each filter and set of others before it: filter, set, and the sizes."""
    unions = {0: np.empty(0, np.int64)}
    for before in range(1, 1 << len(FILTERS)):
        last = before.bit_length() - 1
        unions[before] = union(unions[before ^ (1 << last)], lists[FILTERS[last]])
    everything = (1 << len(FILTERS)) - 1
    for bit, name in enumerate(FILTERS):
        ids = lists[name]
        only = len(difference(ids, unions[everything ^ (1 << bit)]))
        for before in range(1 << len(FILTERS)):
            if before >> bit & 1:
                continue
            removed = difference(ids, unions[before])
            lost = [int(held(removed, lists[label]).sum()) for label in ("good", "toxic")]
            yield name, before, n, len(unions[before]), len(removed), len(ids), only, *lost


def interaction_sizes(lists: DataFrame) -> DataFrame:
    """part, filter, before (bits of the filters that came before) and the sizes, summed over all ranges of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, counts = batch.column("part").to_pylist(), batch.column("n").to_pylist()
            for i, (part, n) in enumerate(zip(parts, counts)):
                own = {name: np.asarray(batch.column(name)[i].values.to_numpy(zero_copy_only=False), np.int64) for name in LISTS}
                names, *numbers = zip(*interactions(n, own))
                columns = [pa.array([part] * len(names), pa.string()), pa.array(names, pa.string()), *map(ints, numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter", "before", *SIZES])

    sizes = ", ".join(f"{name} bigint" for name in SIZES)
    found = lists.mapInArrow(run, f"part string, filter string, before bigint, {sizes}")
    return found.groupBy("part", "filter", "before").agg(*[F.sum(name).alias(name) for name in SIZES])


def filter_orders(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the five filters and step: what the filter of the step keeps, removes and would have removed."""
    spark = docs.sparkSession
    sizes = settle(interaction_sizes(postings(judged(docs), labels)))
    steps = [
        ("".join(order), step + 1, name, sum(1 << FILTERS.index(earlier) for earlier in order[:step]))
        for order in permutations(FILTERS)
        for step, name in enumerate(order)
    ]
    orders = spark.createDataFrame(steps, "filter_order string, step int, filter string, before bigint")
    # so many orders have just these filters before this one
    ways = {n: factorial(n) * factorial(len(FILTERS) - 1 - n) for n in range(len(FILTERS))}
    weight = F.element_at(F.create_map(*[F.lit(v) for pair in ways.items() for v in pair]), F.bit_count("before"))
    shares = sizes.groupBy("part", "filter").agg(F.sum(F.col("removed") * weight).cast("bigint").alias("shapley"))
    return (
        sizes.join(shares, ["part", "filter"])
        .join(F.broadcast(orders), ["filter", "before"])  # 600 rows
        .select(
            "part",
            "filter_order",
            "step",
            (F.col("n") - F.col("gone") - F.col("removed")).alias("kept"),
            "removed",
            (F.col("fails") - F.col("removed")).alias("redundant"),
            F.col("only").alias("unique_fails"),
            F.col("good").alias("good_lost"),
            F.col("toxic").alias("toxic_lost"),
            "shapley",
        )
    )
