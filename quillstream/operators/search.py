"""Reads of the index: full-text, nearest-neighbour and hybrid search, filters and look-ups.

Queries are a DataFrame `(query_id, ...)`; every search ranks by query within each index, ties going to the lower row_id.
Scores are rounded to six places before ranking, so that the order does not hang on the last bits of a sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.arrow import expand, matrix
from ..functions.text import analyze
from ..plans.sizing import broadcast_if_small, measure
from ..session import settle

# The usual BM25 parameters, and the rank constant of reciprocal rank fusion.
K1, B = 1.2, 0.75
RRF_RANK = 60

GROUP = ["query_id", "index_name"]
PLACES = 6

# Query vectors a task holds at once; more queries are searched block after block.
QUERY_BYTES = 4 << 20
# Best hits a task keeps before it hands them on.
KEPT_HITS = 2_000_000
# Pairs of a query and a row that a task scores at once; it holds some ten arrays of them.
CELLS = 500_000
# Random vectors of 64 places need as many tables for nine of ten neighbours; README has the recall by scale.
LSH_TABLES, LSH_BITS = 64, 6
# Query terms up to this number are looked for in the JVM already, so that other tokens never reach Python.
LISTED_TERMS = 2_000


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """Best `k` hits of each query and index. Spark cuts each group to `k` before the shuffle too."""
    best = Window.partitionBy(*GROUP).orderBy(F.desc("score"), "row_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# Full text


def analyzed(idx: DataFrame) -> DataFrame:
    """Tokens of each row; a row without tokens is not part of full-text statistics."""
    tokens = idx.select("index_name", "row_id", analyze(F.col("text")).alias("tokens"))
    return tokens.withColumn("n_terms", F.size("tokens")).where("n_terms > 0")


def postings(idx: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Term counts of each row: `index_name, row_id, n_terms, term, tf`; only for `terms` where given.

    All tokens of a row are at hand where the row is, so they are counted there and nothing is shuffled. Write the
    result sorted by term to keep it as an inverted index.
    """
    keep = ["index_name", "row_id", "n_terms"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            if not len(tokens.flatten()):
                continue
            coded = tokens.flatten().dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(tokens)), tokens.value_lengths().to_numpy(zero_copy_only=False))
            pairs, tf = np.unique(row * len(coded.dictionary) + codes, return_counts=True)
            rows, terms = np.divmod(pairs, len(coded.dictionary))
            yield expand(batch, keep, rows, {"term": coded.dictionary.take(pa.array(terms)), "tf": pa.array(tf, pa.int64())})

    tokens = analyzed(idx).select(*keep, "tokens")
    schema = T.StructType(
        [tokens.schema[name] for name in keep] + [T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]
    )
    counted = tokens.mapInArrow(count, schema)
    if terms is None:
        return counted
    wanted = broadcast_if_small(terms.select("term").distinct())
    return counted.join(wanted, "term", "left_semi").select(*keep, "term", "tf")


def query_terms(queries: DataFrame) -> DataFrame:
    """Terms of each query with how often they are in it."""
    terms = queries.select("query_id", F.explode(analyze(F.col("text"))).alias("term"))
    return terms.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("query_tf"))


COUNTS = ("index_name", "row_id", "n_terms")


def term_counts(idx: DataFrame, terms: DataFrame) -> DataFrame:
    """One record for each row that has tokens: its length, and the counts of those query terms it holds.

    `index_name, row_id, n_terms, terms array<string>, counts array<bigint>`; nothing is shuffled. Query terms too many
    to hold in a task are not filtered by, and the record has the counts of all its terms.
    """
    wanted = settle(terms.select("term").distinct())
    listed = [row["term"] for row in wanted.collect()] if measure(wanted)[1] <= QUERY_BYTES else None
    known = None if listed is None else pa.array(listed, pa.string())
    tokens = analyzed(idx).select(*COUNTS, "tokens")
    if listed is not None and len(listed) <= LISTED_TERMS:
        tokens = tokens.withColumn("tokens", F.filter("tokens", lambda token: token.isin(listed)) if listed else F.slice("tokens", 1, 0))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("tokens")
            coded = column.flatten().dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
            if known is not None and len(codes):
                asked = pc.is_in(coded.dictionary, value_set=known).to_numpy(zero_copy_only=False)[codes]
                row, codes = row[asked], codes[asked]
            width = max(1, len(coded.dictionary))
            pairs, tf = np.unique(row * width + codes, return_counts=True)
            rows, found = np.divmod(pairs, width)
            offsets = pa.array(np.searchsorted(rows, np.arange(len(column) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, values) for values in (coded.dictionary.take(pa.array(found)), pa.array(tf, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=[*COUNTS, "terms", "counts"])

    lists = [T.StructField("terms", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))]
    return tokens.mapInArrow(count, T.StructType([tokens.schema[name] for name in COUNTS] + lists))


def term_weights(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """Weight of each query term in each index: inverse document frequency times its count in the query; with the mean
    length of the index. All of it comes from `counts`."""
    statistics = counts.groupBy("index_name").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("n_terms").alias("mean_terms"))
    df = counts.select("index_name", F.explode("terms").alias("term")).groupBy("index_name", "term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.col("n_rows") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return (
        df.join(statistics, "index_name")
        .join(terms, "term")
        .select("query_id", "index_name", "term", "mean_terms", (idf * F.col("query_tf")).alias("weight"))
    )


def bm25_search(idx: DataFrame, queries: DataFrame, k: int = 10, k1: float = K1, b: float = B) -> DataFrame:
    """Top `k` rows of each index for each text query, by BM25 over the statistics of that index.

    Texts are read and tokenised once; the counts of the query terms are settled. All counts of a row are in one
    record, so a row is scored where it is, and each task hands on its best `k` rows of each query and index only.
    Weights are shared in blocks of queries of bounded size.
    """
    terms = settle(query_terms(queries))
    counts = settle(term_counts(idx, terms))
    weights = settle(term_weights(counts, terms))
    query_type = queries.schema["query_id"].dataType
    blocks = max(1, -(-measure(weights)[1] // QUERY_BYTES))
    part = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    parts = []
    for block in range(blocks):
        rows = (weights.where(part == block) if blocks > 1 else weights).collect()
        hits = top_k(_score_texts(counts.where(F.size("terms") > 0), query_type, rows, k, k1, b), k)
        parts.append(hits if blocks == 1 else settle(hits))
    return reduce(DataFrame.unionByName, parts)


class _Weights:
    """Weights of the query terms of one index, by term."""

    def __init__(self, rows: list):
        self.mean = rows[0]["mean_terms"]
        self.queries = list(dict.fromkeys(row["query_id"] for row in rows))
        place = {query: i for i, query in enumerate(self.queries)}
        self.terms = {term: i for i, term in enumerate(dict.fromkeys(row["term"] for row in rows))}
        number = np.array([self.terms[row["term"]] for row in rows])
        order = np.argsort(number, kind="stable")
        self.query = np.array([place[row["query_id"]] for row in rows])[order]
        self.weight = np.array([row["weight"] for row in rows])[order]
        self.starts = np.searchsorted(number[order], np.arange(len(self.terms) + 1))

    def scores(self, row: np.ndarray, term: np.ndarray, part: np.ndarray, rows: int) -> np.ndarray:
        """Scores by (query, row), from the parts that terms add to rows; -inf where no term is shared."""
        held = term >= 0
        row, term, part = row[held], term[held], part[held]
        sizes = self.starts[term + 1] - self.starts[term]
        at = np.repeat(self.starts[term] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        cell = self.query[at] * rows + np.repeat(row, sizes)
        total = np.bincount(cell, np.repeat(part, sizes) * self.weight[at], len(self.queries) * rows)
        total = np.floor(total * 10**PLACES + 0.5) / 10**PLACES
        total[np.bincount(cell, minlength=len(total)) == 0] = -np.inf
        return total.reshape(len(self.queries), rows)


def _score_texts(counts: DataFrame, query_type: T.DataType, weights: list, k: int, k1: float, b: float) -> DataFrame:
    """Best `k` rows of each query and index in each task."""
    by_index: dict[str, list] = {}
    for row in weights:
        by_index.setdefault(row["index_name"], []).append(row)
    shared = counts.sparkSession.sparkContext.broadcast({name: _Weights(rows) for name, rows in by_index.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Hits(k, query_type, id_type)
        for batch in batches:
            names = np.asarray(batch.column("index_name").to_pylist(), dtype=object)
            ids = np.asarray(batch.column("row_id").to_pylist(), dtype=object)
            terms, lengths = batch.column("terms"), batch.column("n_terms").to_numpy(zero_copy_only=False)
            coded = terms.flatten().dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            tf = batch.column("counts").flatten().to_numpy(zero_copy_only=False).astype(float)
            row = np.repeat(np.arange(len(terms)), terms.value_lengths().to_numpy(zero_copy_only=False))
            for name in dict.fromkeys(names.tolist()):
                own = shared.value.get(name)
                if own is None:
                    continue
                number = np.array([own.terms.get(term, -1) for term in coded.dictionary.to_pylist()] or [-1])
                mine = np.flatnonzero(names == name)
                step = max(1, CELLS // len(own.queries))
                for start in range(0, len(mine), step):
                    some = mine[start : start + step]
                    at = np.flatnonzero(np.isin(row, some))
                    length = 1 - b + b * lengths[row[at]] / own.mean
                    part = tf[at] * (k1 + 1) / (tf[at] + k1 * length)
                    scores = own.scores(np.searchsorted(some, row[at]), number[codes[at]], part, len(some))
                    kept.add(name, own.queries, ids[some], scores)
            yield from kept.flush(KEPT_HITS)
        yield from kept.flush(0)

    id_type = counts.schema["row_id"].dataType
    return counts.mapInArrow(run, _hit_schema(query_type, id_type))


# Nearest neighbours


def _query_blocks(queries: DataFrame, dim: int) -> list[DataFrame]:
    """Queries of the right dimension, cut into blocks small enough for the driver and for every task."""
    # settled, as a model may have made the vectors
    usable = settle(queries.where(F.size("embedding") == dim).select("query_id", "embedding"))
    blocks = max(1, -(-measure(usable)[1] // QUERY_BYTES))
    if blocks == 1:
        return [usable]
    return [usable.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block) for block in range(blocks)]


def _query_matrix(block: DataFrame, dim: int) -> tuple[list, np.ndarray]:
    """Ids and vectors of one block; a vector of length 0 has no direction and finds nothing."""
    rows = [row for row in block.collect() if any(row["embedding"])]
    return [row["query_id"] for row in rows], np.array([row["embedding"] for row in rows], float).reshape(len(rows), dim)


def _cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines by (query, row), rounded half away from zero as SQL does; -inf for rows of length 0."""
    norms = np.linalg.norm(rows, axis=1)
    lengths = np.linalg.norm(queries, axis=1)[:, None] * np.where(norms > 0, norms, 1.0)
    scaled = queries @ rows.T / lengths * 10**PLACES
    cosines = np.copysign(np.floor(np.abs(scaled) + 0.5), scaled) / 10**PLACES + 0.0
    cosines[:, norms == 0] = -np.inf
    return cosines


class _Best:
    """Best hits so far of one index in one task, by query; ties go to the lower id.

    `codes` point into `pool`, the sorted ids in use, so that ties compare numbers.
    """

    def __init__(self, queries: int, k: int):
        self.k = k
        self.pool = None
        self.codes = np.empty((queries, 0), dtype=np.int64)
        self.scores = np.empty((queries, 0))

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores are (queries, rows); -inf marks a pair that is no candidate."""
        if scores.shape[1] > 4 * self.k:
            # rows that are among the best of some query, by score alone; ties at the edge stay
            edge = np.partition(scores, -self.k, axis=1)[:, -self.k, None]
            useful = ((scores >= edge) & (scores > -np.inf)).any(axis=0)
            ids, scores = ids[useful], scores[:, useful]
        if not len(ids):
            return
        known = 0 if self.pool is None else len(self.pool)
        pool, places = np.unique(ids if not known else np.concatenate([self.pool, ids]), return_inverse=True)
        codes = np.hstack([places[:known][self.codes], np.broadcast_to(places[known:], scores.shape)])
        scores = np.hstack([self.scores, scores])
        order = np.lexsort((codes, -scores), axis=1)[:, : self.k]
        codes, self.scores = np.take_along_axis(codes, order, 1), np.take_along_axis(scores, order, 1)
        used, inverse = np.unique(codes, return_inverse=True)
        self.pool, self.codes = pool[used], inverse.reshape(codes.shape)

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, ids and scores of the kept candidates."""
        query, place = np.nonzero(self.scores > -np.inf)
        return query, self.pool[self.codes[query, place]] if len(query) else np.empty(0, object), self.scores[query, place]


def _hit_schema(query_type: T.DataType, id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", query_type),
            T.StructField("index_name", T.StringType()),
            T.StructField("row_id", id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


class _Hits:
    """Best hits of one task by index, handed on when there are many."""

    def __init__(self, k: int, query_type: T.DataType, id_type: T.DataType):
        self.k = k
        self.types = to_arrow_type(query_type), to_arrow_type(id_type)
        self.best: dict[str, tuple[list, _Best]] = {}

    def add(self, name: str, queries: list, ids: np.ndarray, scores: np.ndarray) -> None:
        if name not in self.best:
            self.best[name] = queries, _Best(len(queries), self.k)
        self.best[name][1].add(ids, scores)

    def flush(self, limit: int) -> Iterator[pa.RecordBatch]:
        """Batches of all hits if more than `limit` may be held."""
        if sum(len(queries) for queries, _ in self.best.values()) * self.k <= limit:
            return
        for name, (queries, best) in self.best.items():
            query, ids, scores = best.hits()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([queries[q] for q in query], self.types[0]),
                    pa.array([name] * len(query), pa.string()),
                    pa.array(ids.tolist(), self.types[1]),
                    pa.array(scores, pa.float64()),
                ],
                names=["query_id", "index_name", "row_id", "score"],
            )
        self.best.clear()


def _sharing_pairs(tables: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row that share a bucket in some table, each once; other pairs are never looked at."""
    shared = np.zeros(len(tables) * len(buckets), dtype=bool)
    for table in range(tables.shape[1]):
        order = np.argsort(buckets[:, table], kind="stable")
        sorted_buckets = buckets[order, table]
        low, high = (np.searchsorted(sorted_buckets, tables[:, table], side) for side in ("left", "right"))
        sizes = high - low
        at = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        shared[np.repeat(np.arange(len(tables)), sizes) * len(buckets) + order[at]] = True
    return np.divmod(np.flatnonzero(shared), max(1, len(buckets)))


def _pair_cosines(queries: np.ndarray, rows: np.ndarray, query: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Cosines by (query, row), of the given pairs only; -inf for all others."""
    out = np.full((len(queries), len(rows)), -np.inf)
    norms, lengths = np.linalg.norm(rows, axis=1), np.linalg.norm(queries, axis=1)
    step = max(1, CELLS // rows.shape[1])
    for start in range(0, len(query), step):
        q, r = query[start : start + step], row[start : start + step]
        q, r = q[norms[r] > 0], r[norms[r] > 0]
        scaled = np.einsum("pd,pd->p", queries[q], rows[r]) / (lengths[q] * norms[r]) * 10**PLACES
        out[q, r] = np.copysign(np.floor(np.abs(scaled) + 0.5), scaled) / 10**PLACES + 0.0
    return out


def _scan(
    rows: DataFrame, query_type: T.DataType, query_ids: list, vectors: np.ndarray, k: int, tables: np.ndarray | None
) -> DataFrame:
    """Candidates for the top `k`: every task scores its rows against all queries and hands on its best.

    Rows are scored in tiles of at most `CELLS` pairs, so what a task holds does not grow with queries times rows.
    """
    shared = rows.sparkSession.sparkContext.broadcast((query_ids, vectors, tables))
    dim = vectors.shape[1]
    id_type = rows.schema["row_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, vectors, tables = shared.value
        if not query_ids:
            return
        kept = _Hits(k, query_type, id_type)
        step = max(1, CELLS // len(query_ids))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                data = matrix(batch.column("embedding"), dim)
                if tables is None:
                    scores = _cosines(vectors, data)
                else:
                    buckets = matrix(batch.column("lsh"), tables.shape[1]).astype(np.int64)
                    scores = _pair_cosines(vectors, data, *_sharing_pairs(tables, buckets))
                names = np.asarray(batch.column("index_name").to_pylist(), dtype=object)
                ids = np.asarray(batch.column("row_id").to_pylist(), dtype=object)
                for name in dict.fromkeys(names.tolist()):
                    mine = names == name
                    kept.add(name, query_ids, ids[mine], scores[:, mine])
                yield from kept.flush(KEPT_HITS)
        yield from kept.flush(0)

    return rows.mapInArrow(run, _hit_schema(query_type, id_type))


def _nearest(idx: DataFrame, queries: DataFrame, k: int, dim: int, lsh: tuple[int, int] | None) -> DataFrame:
    rows = idx.where(F.size("embedding") == dim)
    query_type = queries.schema["query_id"].dataType
    blocks = _query_blocks(queries, dim)
    parts: list[DataFrame] = []
    for block in blocks:
        query_ids, vectors = _query_matrix(block, dim)
        tables, near = None, rows.select("index_name", "row_id", "embedding")
        if lsh is not None:
            tables = lsh_buckets(vectors, *lsh)
            near = rows.select("index_name", "row_id", "embedding", "lsh")
            if _prunes(tables, lsh[1]):
                wanted = F.array(*[F.lit(int(bucket)) for bucket in np.unique(tables)]).cast("array<int>")
                near = near.where(F.arrays_overlap("lsh", wanted))
        hits = top_k(_scan(near, query_type, query_ids, vectors, k, tables), k)
        # With several blocks, one is finished before the next is fetched.
        parts.append(hits if len(blocks) == 1 else settle(hits))
    return reduce(DataFrame.unionByName, parts)


def knn_search(idx: DataFrame, queries: DataFrame, k: int, dim: int) -> DataFrame:
    """Exact top `k` rows of each index by cosine, for query vectors of the given dimension.

    One scan of the vectors, no join: queries are a bounded block in every task, which hands on its best hits.
    """
    return _nearest(idx, queries, k, dim, None)


@cache
def lsh_planes(dim: int, tables: int, bits: int) -> np.ndarray:
    """Hyperplanes of +1 and -1, from a hash of their place: the same on every machine and in SQL."""
    names = (f"{table}:{bit}:{place}" for table in range(tables) for bit in range(bits) for place in range(dim))
    signs = [1.0 if int(hashlib.md5(n.encode(), usedforsecurity=False).hexdigest()[0], 16) < 8 else -1.0 for n in names]
    return np.array(signs).reshape(tables, bits, dim)


def lsh_buckets(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket of each vector in each table: one bit per plane, the table number above them."""
    planes = lsh_planes(vectors.shape[1], tables, bits)
    sides = np.einsum("nd,tbd->ntb", vectors, planes) >= 0
    return (sides @ (1 << np.arange(bits))) + (np.arange(tables) << bits)


def _prunes(tables: np.ndarray, bits: int) -> bool:
    """Whether a tenth of the rows at least is expected to share no bucket with any query; else the filter only costs."""
    held = np.array([len(np.unique(buckets)) for buckets in tables.T])
    return bool(np.prod(1 - held / (1 << bits)) >= 0.1)


def with_lsh(idx: DataFrame, dim: int, tables: int = LSH_TABLES, bits: int = LSH_BITS) -> DataFrame:
    """Add the `lsh` buckets of each vector; store them with the index so that a search reads them only."""
    keep = list(idx.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                buckets = lsh_buckets(matrix(batch.column("embedding"), dim), tables, bits).astype(np.int32)
                offsets = pa.array(np.arange(0, buckets.size + 1, tables, dtype=np.int32))
                column = pa.ListArray.from_arrays(offsets, pa.array(buckets.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*keep, "lsh"])

    schema = T.StructType([*idx.schema.fields, T.StructField("lsh", T.ArrayType(T.IntegerType()))])
    return idx.where(F.size("embedding") == dim).mapInArrow(run, schema)


def knn_lsh(
    idx: DataFrame, queries: DataFrame, k: int, dim: int, tables: int = LSH_TABLES, bits: int = LSH_BITS
) -> DataFrame:
    """Approximate top `k` by cosine: only rows that share a bucket with a query are scored, and those exactly.

    `idx` comes from `with_lsh` with the same `tables` and `bits`. Fewer tables or more bits score fewer pairs and lose
    neighbours; `recall` tells how many.
    """
    return _nearest(idx, queries, k, dim, (tables, bits))


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search found, by query."""
    found = approximate.select(*GROUP, "row_id").withColumn("_found", F.lit(1))
    return (
        exact.join(found, [*GROUP, "row_id"], "left")
        .groupBy("query_id")
        .agg(F.count(F.lit(1)).alias("n_exact"), F.count("_found").alias("n_found"))
        .withColumn("recall", F.col("n_found") / F.col("n_exact"))
    )


# Hybrid


def _min_max(hits: DataFrame, name: str) -> DataFrame:
    """Scores scaled to 0..1 within each query and index; a group is a top-k list, and lies together already."""
    group = Window.partitionBy(*GROUP)
    low, spread = F.min("score").over(group), F.max("score").over(group) - F.min("score").over(group)
    scaled = F.when(spread == 0, F.lit(1.0)).otherwise((F.col("score") - low) / spread)
    return hits.select(*GROUP, "row_id", scaled.alias(name))


def fuse(text_hits: DataFrame, vector_hits: DataFrame, k: int, weight: float = 0.5, fusion: str = "min_max") -> DataFrame:
    """Join two hit lists: weighted mean of min-max scores, or reciprocal ranks; a missing hit adds 0."""
    if fusion == "min_max":
        left, right = _min_max(text_hits, "_text"), _min_max(vector_hits, "_vector")
        score = weight * F.col("_text") + (1 - weight) * F.col("_vector")
    elif fusion == "rrf":
        left = text_hits.select(*GROUP, "row_id", (1 / (RRF_RANK + F.col("rank"))).alias("_text"))
        right = vector_hits.select(*GROUP, "row_id", (1 / (RRF_RANK + F.col("rank"))).alias("_vector"))
        score = F.col("_text") + F.col("_vector")
    else:
        raise ValueError(f"unknown fusion {fusion!r}")
    joined = left.join(right, [*GROUP, "row_id"], "full_outer").na.fill(0.0, ["_text", "_vector"])
    return top_k(joined.select(*GROUP, "row_id", F.round(score, PLACES).alias("score")), k)


def hybrid_search(
    idx: DataFrame,
    queries: DataFrame,
    k: int,
    dim: int,
    weight: float = 0.5,
    fusion: str = "min_max",
    depth: int | None = None,
) -> DataFrame:
    """BM25 and nearest-neighbour hits of `depth` (default `k`) each, fused to the top `k`.

    Queries carry `text` and `embedding`.
    """
    depth = depth or k
    return fuse(bm25_search(idx, queries, depth), knn_search(idx, queries, depth, dim), k, weight, fusion)


# Filters and look-ups


def filter_index(idx: DataFrame, **conditions) -> DataFrame:
    """Rows that meet every condition: a value, a list of values, a `(low, high)` range with open ends as None, or None."""
    for name, wanted in conditions.items():
        col = F.col(name)
        if wanted is None:
            idx = idx.where(col.isNull())
        elif isinstance(wanted, tuple):
            low, high = wanted
            idx = idx.where(col >= low) if low is not None else idx
            idx = idx.where(col <= high) if high is not None else idx
        elif isinstance(wanted, (list, set, frozenset)):
            idx = idx.where(col.isin(*wanted))
        else:
            idx = idx.where(col == wanted)
    return idx


def lookup_doc(idx: DataFrame, index_name: str, doc_id: str) -> DataFrame:
    """Rows of one document in one index; exact, with no white space removed."""
    return filter_index(idx, index_name=index_name, doc_id=doc_id)


def lookup_docs(idx: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of all `(index_name, doc_id)` pairs in `wanted`."""
    pairs = broadcast_if_small(wanted.select("index_name", "doc_id").distinct())
    return idx.join(pairs, ["index_name", "doc_id"], "left_semi")


def index_head(idx: DataFrame, index_name: str, n: int = 10) -> DataFrame:
    """First `n` rows of one index, by row_id."""
    return idx.where(F.col("index_name") == index_name).orderBy("row_id").limit(n)


def index_heads(idx: DataFrame, n: int = 10) -> DataFrame:
    """First `n` rows of every index, by row_id."""
    first = Window.partitionBy("index_name").orderBy("row_id")
    return idx.withColumn("position", F.row_number().over(first)).where(F.col("position") <= n)
