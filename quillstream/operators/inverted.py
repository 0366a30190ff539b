"""A stored inverted index, and BM25 that reads postings instead of texts.

`build_inverted` writes the postings of each (index, term) in blocks of `BLOCK` rows, sorted by index, term and what the term adds
to the row's score, the most first. So file statistics skip the terms nobody asks for, a term of very many rows lies in many
files, and the rows of a block are worth about the same. A block carries its greatest count and its shortest row, which bound
the score that any row of it can get from its term, whatever the mean length of the index has become.

`inverted_search` gives the hits of `bm25_search`. It first scores the blocks that promise most, as many as hold `SEEDS * k`
postings for each query and index; the k-th of these scores is a floor of the k-th score of all. A block is skipped if its own bound
and the greatest bounds of the query's other terms stay below the floor: then no row in it can be a hit, and leaving it out makes
the score of no hit smaller. The rest is exploded and summed by row. All of it is joins and aggregates: no text is read, and no
query passes the driver. Blocks are skipped where few terms decide; of a query of many terms that all weigh little, any block
may matter, and few are.

Rows without tokens are in no statistics; rows that repeat an id are added up as one; an empty index gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..plans.sizing import broadcast_if_small
from ..session import settle
from .search import B, GROUP, K1, LISTED_TERMS, PLACES, analyzed, postings, query_terms, top_k

BLOCK = 128
SEEDS = 4  # times k postings that the floor is taken from
TASK_POSTINGS = 4_000_000  # postings, once for each query that asks for them, that a task adds up or sorts
SLACK = 10.0**-PLACES  # scores are rounded to so many places


@dataclass(frozen=True)
class Inverted:
    """A written index: blocks of postings, and the number and the length of the rows of each index."""

    blocks: DataFrame  # index_name, term, ids, counts, lengths, top_count, least_length
    sizes: DataFrame  # index_name, n_rows, n_terms


def _blocks_of(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Blocks of postings that come sorted by index and term; a block ends with its term, at `BLOCK` rows, or with the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names, terms = (batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False) for name in ("index_name", "term"))
        new = np.ones(batch.num_rows, bool)
        new[1:] = (np.diff(names) != 0) | (np.diff(terms) != 0)
        starts = np.flatnonzero(new)
        place = np.arange(batch.num_rows) - np.repeat(starts, np.diff(np.append(starts, batch.num_rows)))
        starts = np.flatnonzero(place % BLOCK == 0)
        offsets, first = pa.array(np.append(starts, batch.num_rows), pa.int32()), pa.array(starts)
        counts, lengths = (batch.column(name).to_numpy().astype(np.int32) for name in ("tf", "n_terms"))
        lists = [batch.column("row_id").cast(id_type), pa.array(counts), pa.array(lengths)]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name).take(first) for name in ("index_name", "term")],
                *[pa.ListArray.from_arrays(offsets, values) for values in lists],
                pa.array(np.maximum.reduceat(counts, starts)),
                pa.array(np.minimum.reduceat(lengths, starts)),
            ],
            names=["index_name", "term", "ids", "counts", "lengths", "top_count", "least_length"],
        )


def build_inverted(idx: DataFrame) -> Inverted:
    """Tokenise idx(index_name, row_id, text) once and write its postings."""
    id_type = idx.schema["row_id"].dataType
    sizes = analyzed(idx).groupBy("index_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_terms").cast("bigint").alias("n_terms"))
    sizes = settle(sizes)
    means = sizes.select("index_name", (F.col("n_terms") / F.col("n_rows")).alias("mean_terms"))
    order = ["index_name", "term", F.desc("worth"), "row_id"]
    valued = postings(idx).join(broadcast_if_small(means), "index_name").withColumn("worth", _part("tf", "n_terms", K1, B))
    # a row has no more postings than tokens
    tokens = sizes.agg(F.sum("n_terms")).first()[0] or 0
    parts = max(idx.sparkSession.sparkContext.defaultParallelism, -(-tokens // TASK_POSTINGS))
    held = valued.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("mean_terms", "worth")
    text, numbers = T.StringType(), T.ArrayType(T.IntegerType())
    kinds = [text, text, T.ArrayType(id_type), numbers, numbers, T.IntegerType(), T.IntegerType()]
    names = ["index_name", "term", "ids", "counts", "lengths", "top_count", "least_length"]
    arrow_id = to_arrow_type(id_type)
    blocks = held.mapInArrow(lambda batches: _blocks_of(batches, arrow_id), T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)]))
    return Inverted(settle(blocks), sizes)


def _part(count: Column | str, length: Column | str, k1: float, b: float) -> Column:
    """What a term adds to the score of a row, but for its weight; grows with the count and falls with the length."""
    count, length = (F.col(c) if isinstance(c, str) else c for c in (count, length))
    return count * (k1 + 1) / (count + k1 * (1 - b + b * length / F.col("mean_terms")))


def _blocks_with(index: Inverted, terms: DataFrame) -> DataFrame:
    """Blocks of the terms; of few terms, by a filter that reaches the file statistics."""
    wanted = terms.select("term").distinct()
    listed = [row["term"] for row in wanted.limit(LISTED_TERMS + 1).collect()]  # few rows, by the limit
    if len(listed) <= LISTED_TERMS:
        return index.blocks.where(F.col("term").isin(listed))
    return index.blocks.join(broadcast_if_small(settle(wanted)), "term", "left_semi")


def _asked_blocks(index: Inverted, queries: DataFrame, k1: float, b: float) -> DataFrame:
    """Blocks of the terms of each query, with the weight of the term in the index and the `bound` of the block."""
    terms = settle(query_terms(queries))
    blocks = _blocks_with(index, terms)
    sizes = index.sizes.select("index_name", "n_rows", (F.col("n_terms") / F.col("n_rows")).alias("mean_terms"))
    df = blocks.groupBy("index_name", "term").agg(F.sum(F.size("ids")).alias("df"))
    idf = F.log(1 + (F.col("n_rows") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = df.join(broadcast_if_small(sizes), "index_name").join(broadcast_if_small(terms), "term")
    weights = settle(weights.select(*GROUP, "term", "mean_terms", (idf * F.col("query_tf")).alias("weight")))
    asked = blocks.join(broadcast_if_small(weights), ["index_name", "term"])
    return asked.withColumn("bound", F.col("weight") * _part("top_count", "least_length", k1, b))


def _scored(blocks: DataFrame, k1: float, b: float) -> DataFrame:
    """Scores of the rows that the blocks hold, from these blocks only."""
    rows = blocks.select(*GROUP, "weight", "mean_terms", F.explode(F.arrays_zip("ids", "counts", "lengths")).alias("row"))
    part = F.col("weight") * _part("row.counts", "row.lengths", k1, b)
    total = rows.groupBy(*GROUP, F.col("row.ids").alias("row_id")).agg(F.sum(part).alias("total"))
    return total.select(*GROUP, "row_id", _rounded("total").alias("score"))


def _rounded(total: str) -> Column:
    return F.floor(F.col(total) * 10**PLACES + 0.5) / 10**PLACES


def _seeds(asked: DataFrame, k: int) -> DataFrame:
    """The asked blocks that promise most, as many as hold `SEEDS * k` postings for each query and index.

    They are ranked without their postings; blocks up to the last one that is needed are then read once more.
    """
    place = [(-F.col("bound")).alias("fall"), F.col("term"), F.element_at("ids", 1).alias("first")]
    ranks = asked.select(*GROUP, *place, F.size("ids").alias("n"))
    # all blocks of one term of one query and index tie with those of no other group; Spark cuts groups before the shuffle too
    first = Window.partitionBy(*GROUP).orderBy("fall", "term", "first")
    most = ranks.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= SEEDS * k)
    # the fewest of these that hold enough postings, at one a block in the worst case
    held = F.coalesce(F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = most.withColumn("held", held).where(F.col("held") < SEEDS * k)
    last = chosen.groupBy(*GROUP).agg(F.max(F.struct("fall", "term", "first")).alias("last"))
    return asked.join(broadcast_if_small(settle(last)), GROUP).where(F.struct(*place) <= F.col("last")).drop("last")


def _limits(asked: DataFrame, k: int, k1: float, b: float) -> DataFrame:
    """Terms of each query and index, with their weight and the `least` bound of a block in which a row can be among the best `k`."""
    floor = top_k(_scored(_seeds(asked, k), k1, b), k).groupBy(*GROUP).agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floor = floor.select(*GROUP, F.when(F.col("n") == k, F.col("floor")).otherwise(0.0).alias("floor"))
    bounds = asked.groupBy(*GROUP, "term").agg(
        F.max("bound").alias("best"), F.max("weight").alias("weight"), F.max("mean_terms").alias("mean_terms"), F.sum(F.size("ids")).alias("n_postings")
    )
    together = bounds.groupBy(*GROUP).agg(F.sum("best").alias("together"))
    least = F.coalesce("floor", F.lit(0.0)) - (F.col("together") - F.col("best")) - SLACK
    limits = bounds.join(together, GROUP).join(floor, GROUP, "left")
    return settle(limits.select(*GROUP, "term", "weight", "mean_terms", "n_postings", least.alias("least")))


def _needed(asked: DataFrame, limits: DataFrame) -> DataFrame:
    """The asked blocks without those in which no row can be among the best."""
    least = limits.select(*GROUP, "term", "least")
    return asked.join(broadcast_if_small(least), [*GROUP, "term"]).where(F.col("bound") >= F.col("least")).drop("least")


def _scored_by_row(index: Inverted, limits: DataFrame, k1: float, b: float) -> DataFrame:
    """Scores of all rows in needed blocks.

    Postings are dealt out by row before they meet the queries, in as many parts as keep `TASK_POSTINGS` for a task, so what a
    task sums up does not grow with the index, and only postings that some query needs are shuffled, each once.
    """
    part = _part("top_count", "least_length", k1, b)
    # weights are above 0, so a block that no query needs is below the least of these
    asked = limits.groupBy("index_name", "term").agg(F.min(F.col("least") / F.col("weight")).alias("least"), F.max("mean_terms").alias("mean_terms"))
    blocks = _blocks_with(index, limits).join(broadcast_if_small(settle(asked)), ["index_name", "term"]).where(part >= F.col("least") - SLACK)
    row = F.explode(F.arrays_zip("ids", "counts", "lengths")).alias("row")
    rows = blocks.select("index_name", "term", "top_count", "least_length", row).select(
        "index_name", "term", "top_count", "least_length", F.col("row.ids").alias("row_id"), F.col("row.counts").alias("count"), F.col("row.lengths").alias("length")
    )
    postings = limits.agg(F.sum("n_postings")).first()[0] or 0
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-postings // TASK_POSTINGS))
    dealt = rows.repartition(parts, "index_name", "row_id").join(broadcast_if_small(limits.drop("n_postings")), ["index_name", "term"])
    needed = dealt.where(F.col("weight") * part >= F.col("least"))
    total = needed.groupBy(*GROUP, "row_id").agg(F.sum(F.col("weight") * _part("count", "length", k1, b)).alias("total"))
    return total.select(*GROUP, "row_id", _rounded("total").alias("score"))


def inverted_search(index: Inverted, queries: DataFrame, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
    """Top `k` rows of each index for each text query, by BM25: the hits of `bm25_search`, from stored postings."""
    return top_k(_scored_by_row(index, _limits(_asked_blocks(index, queries, k1, b), k, k1, b), k1, b), k)


def skipped_blocks(index: Inverted, queries: DataFrame, k: int = 10, k1: float = K1, b: float = B) -> dict[str, int]:
    """Blocks of the terms of the queries, and how many of them a search leaves out."""
    asked = _asked_blocks(index, queries, k1, b)
    n = asked.count()
    return {"asked": n, "skipped": n - _needed(asked, _limits(asked, k, k1, b)).count()}
