"""Approximate nearest neighbours through inverted lists with short codes.

`build_cells` trains a coarse quantiser on a bounded sample and writes every row of the index into the list of its nearest
centre: blocks of at most `BLOCK_ROWS` ids with codes of half a byte a dimension (of the offset from the centre), sorted by index and cell, so that file
statistics skip the lists that no query asks for. `knn_cells` finds the nearest cells of each query, compares the query with
the codes in them, and scores only the best of these with the vectors.

How many cells are probed is not a guess: while training, the fewest are taken that hold `PROBED_RECALL` of the nearest rows of
the sample. On clustered vectors they are few; on vectors without any structure they are most, and then the codes are what
spares the exact scores.

Queries never pass the driver and meet blocks in a join: a unit of work is a pack of queries of one cell and a block of its rows,
both bounded, so what a task holds depends neither on the number of rows nor on that of queries. A cell of many blocks is
dealt out in parts of about `PART_BLOCKS`, each with the queries of the cell, so one that holds a third of all rows is work for
many tasks.

Vectors of another dimension or of length 0 are in no list and find nothing; an empty index gives no hits; rows that repeat
an id are rows of their own in the lists, and both are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.arrow import matrix
from ..plans.sizing import broadcast_if_small
from ..session import settle
from .search import GROUP, PLACES, top_k

SAMPLE_BYTES = 32 << 20  # of vectors that the quantiser is trained on
TRIAL_QUERIES = 200  # of the sample, whose nearest rows tell how many cells to probe
TRIAL_NEIGHBOURS = 10
PROBED_RECALL = 0.97
ROUNDS = 12  # of k-means
BLOCK_ROWS, PACK_ROWS = 2048, 256
PART_BLOCKS = 16
REFINE = 4  # so many times k rows are scored exactly
LISTED_CELLS = 1000  # up to this number, the cells asked for are a filter of the scan


@dataclass(frozen=True)
class Cells:
    """A written index of cells: `blocks`, the parts that each cell is dealt out in, the unit vectors of the centres, and how many
    of them a query probes."""

    blocks: DataFrame  # index_name, cell, first_id, ids, codes
    parts: DataFrame  # cell, parts; no more rows than there are centres
    centres: np.ndarray
    probes: int


def _units(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1.0)


def _usable(df: DataFrame, dim: int) -> DataFrame:
    """Rows whose vector has the dimension and a direction."""
    return df.where((F.size("embedding") == dim) & F.exists("embedding", lambda x: x != 0))


def _sample(idx: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Unit vectors of a share of the rows, picked by a hash of their ids, and the number of all rows."""
    rows, wanted = idx.count(), max(1, SAMPLE_BYTES // (8 * dim))
    picked = F.pmod(F.xxhash64("index_name", "row_id"), F.lit(1 << 20)) < F.lit(min(1 << 20, (wanted << 20) // max(1, rows)))
    # rows that repeat an id share its hash: the number is bounded a second time
    sample = idx.where(picked).select("embedding").limit(2 * wanted).toArrow()
    return _units(matrix(sample.column("embedding").combine_chunks(), dim)), rows


def train(sample: np.ndarray, cells: int, seed: int = 0) -> np.ndarray:
    """Centres of spherical k-means; a centre that loses all its vectors takes the vector that lies worst."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.permutation(len(sample))[:cells]].copy()
    for _ in range(ROUNDS):
        near, cosine = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        lost = np.flatnonzero(np.bincount(near, minlength=len(centres)) == 0)
        sums[lost] = sample[np.argsort(cosine)[: len(lost)]]
        centres = _units(sums)
    return centres


def _nearest(vectors: np.ndarray, centres: np.ndarray, tile: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each vector, and its cosine."""
    near, cosine = np.empty(len(vectors), np.int64), np.empty(len(vectors))
    for start in range(0, len(vectors), tile):
        scores = vectors[start : start + tile] @ centres.T
        near[start : start + tile] = scores.argmax(axis=1)
        cosine[start : start + tile] = scores.max(axis=1)
    return near, cosine


def probes_for(sample: np.ndarray, centres: np.ndarray, share: float = PROBED_RECALL) -> int:
    """The fewest cells a query has to probe so that they hold this share of its nearest rows in the sample."""
    queries = sample[: TRIAL_QUERIES]
    near, _ = _nearest(sample, centres)
    ranks = np.empty((len(queries), len(centres)), np.int64)  # of each centre for each query
    np.put_along_axis(ranks, np.argsort(-(queries @ centres.T), axis=1), np.arange(len(centres))[None, :], axis=1)
    k = min(TRIAL_NEIGHBOURS + 1, len(sample))
    asked = [ranks[i, near[np.argpartition(-(sample @ query), k - 1)[:k]]] for i, query in enumerate(queries)]
    return int(np.quantile(np.concatenate(asked), share, method="higher")) + 1 if asked else 1


def encode(offsets: np.ndarray) -> bytes:
    """Half a byte for each place of each offset from the centre, two places in a byte, after the scale (four bytes)."""
    scale = np.float32(max(np.abs(offsets).max(initial=0), 1e-12) / 7.5)
    steps = np.clip(np.rint(offsets / scale + 7.5), 0, 15).astype(np.uint8)
    steps = np.hstack([steps, np.zeros((len(steps), steps.shape[1] % 2), np.uint8)])
    return scale.tobytes() + (steps[:, ::2] << 4 | steps[:, 1::2]).tobytes()


def decode(codes: bytes, dim: int) -> np.ndarray:
    packed = np.frombuffer(codes, np.uint8, offset=4).reshape(-1, (dim + 1) // 2)
    steps = np.stack([packed >> 4, packed & 15], axis=2).reshape(len(packed), -1)[:, :dim]
    return (steps.astype(np.float32) - np.float32(7.5)) * np.frombuffer(codes, np.float32, 1)


def build_cells(idx: DataFrame, dim: int, cells: int | None = None) -> Cells:
    """Index every row of idx(index_name, row_id, embedding) that has a vector of this dimension and not of length 0.

    The number of cells grows with the square root of that of the rows.
    """
    usable = _usable(idx, dim).select("index_name", "row_id", "embedding")
    sample, rows = _sample(usable, dim)
    count = max(1, min(cells or int(rows**0.5), len(sample)))
    centres = train(sample, count) if len(sample) else np.zeros((1, dim))
    shared = idx.sparkSession.sparkContext.broadcast(centres)
    id_type = idx.schema["row_id"].dataType
    plain = [T.StructField("index_name", T.StringType()), T.StructField("cell", T.IntegerType())]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, _ = _nearest(_units(matrix(batch.column("embedding"), dim)), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(near, pa.int32()), *batch.columns[1:]], names=["index_name", "cell", "row_id", "embedding"])

    def block(name: str, cell: int, ids: list, vectors: list[np.ndarray]) -> pa.RecordBatch:
        first = pa.array([ids[0]], to_arrow_type(id_type))
        columns = [pa.array([name], pa.string()), pa.array([cell], pa.int32()), first]
        columns += [pa.array([ids], pa.list_(to_arrow_type(id_type))), pa.array([encode(np.vstack(vectors) - shared.value[cell])], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["index_name", "cell", "first_id", "ids", "codes"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vectors = None, [], []
        for batch in batches:
            keys = list(zip(batch.column("index_name").to_pylist(), batch.column("cell").to_pylist()))
            numbers, units = batch.column("row_id").to_pylist(), _units(matrix(batch.column("embedding"), dim))
            for key, number, unit in zip(keys, numbers, units):
                if ids and (key != now or len(ids) == BLOCK_ROWS):
                    yield block(*now, ids, vectors)
                    ids, vectors = [], []
                now = key
                ids.append(number)
                vectors.append(unit.astype(np.float32))
        if ids:
            yield block(*now, ids, vectors)

    assigned = usable.mapInArrow(assign, T.StructType([*plain, usable.schema["row_id"], usable.schema["embedding"]]))
    # with the row in the range, so that a crowded cell is cut over many tasks
    order = ["index_name", "cell", "row_id"]
    ranged = assigned.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = [*plain, T.StructField("first_id", id_type), T.StructField("ids", T.ArrayType(id_type)), T.StructField("codes", T.BinaryType())]
    blocks = settle(ranged.mapInArrow(pack, T.StructType(fields)))
    parts = blocks.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PART_BLOCKS).cast("int").alias("parts"))
    return Cells(blocks, settle(parts), centres, probes_for(sample, centres))


def _packs(index: Cells, queries: DataFrame, probes: int) -> DataFrame:
    """For each cell, packs of at most `PACK_ROWS` queries that probe it: `cell`, `query_ids`, `vectors`."""
    shared, dim = queries.sparkSession.sparkContext.broadcast(index.centres), index.centres.shape[1]
    query_type = queries.schema["query_id"].dataType

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(matrix(batch.column("embedding"), dim)).astype(np.float32)
            for start in range(0, len(units), PACK_ROWS):
                some, ids = units[start : start + PACK_ROWS], batch.column("query_id").slice(start, PACK_ROWS)
                cells = np.argpartition(-(some @ shared.value.T), min(probes, len(shared.value)) - 1, axis=1)[:, :probes]
                for cell in np.unique(cells):
                    mine = np.flatnonzero((cells == cell).any(axis=1))
                    lists = pa.array([ids.take(pa.array(mine)).to_pylist()], pa.list_(to_arrow_type(query_type)))
                    yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), lists, pa.array([some[mine].tobytes()], pa.binary())], names=["cell", "query_ids", "vectors"])

    fields = [T.StructField("cell", T.IntegerType()), T.StructField("query_ids", T.ArrayType(query_type)), T.StructField("vectors", T.BinaryType())]
    return _usable(queries, dim).select("query_id", "embedding").mapInArrow(probe, T.StructType(fields))


def candidates(index: Cells, queries: DataFrame, keep: int, probes: int | None = None) -> DataFrame:
    """The `keep` rows of each index whose codes are nearest to a query, of the cells that it probes."""
    packs = settle(_packs(index, queries, min(probes or index.probes, len(index.centres))))
    cells = packs.select("cell").distinct().limit(LISTED_CELLS + 1).collect()  # few rows, by the limit
    blocks = index.blocks
    if len(cells) <= LISTED_CELLS:
        blocks = blocks.where(F.col("cell").isin([row["cell"] for row in cells]))
    dim, shared = index.centres.shape[1], queries.sparkSession.sparkContext.broadcast(index.centres)
    query_type, id_type = packs.schema["query_ids"].dataType.elementType, index.blocks.schema["first_id"].dataType

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("ids")[i].values
                vectors = np.frombuffer(batch.column("vectors")[i].as_py(), np.float32).reshape(-1, dim)
                centre = shared.value[batch.column("cell")[i].as_py()].astype(np.float32)
                scores = vectors @ (decode(batch.column("codes")[i].as_py(), dim) + centre).T
                best = np.argpartition(-scores, min(keep, len(ids)) - 1, axis=1)[:, :keep]
                query = np.repeat(np.arange(len(vectors)), best.shape[1])
                columns = [batch.column("query_ids")[i].values.take(pa.array(query)), batch.column("index_name").take(pa.array([i] * len(query), pa.int64()))]
                columns += [ids.take(pa.array(best.ravel())), pa.array(np.take_along_axis(scores, best, 1).ravel().astype(np.float64))]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "index_name", "row_id", "score"])

    fields = [T.StructField("query_id", query_type), T.StructField("index_name", T.StringType())]
    fields += [T.StructField("row_id", id_type), T.StructField("score", T.DoubleType())]
    parts = F.broadcast(index.parts)
    dealt = blocks.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("index_name", "first_id"), F.col("parts")).cast("int"))
    copied = packs.join(parts, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    units = dealt.join(copied, ["cell", "part"]).select("index_name", "cell", "ids", "codes", "query_ids", "vectors")
    return top_k(units.mapInArrow(compare, T.StructType(fields)), keep).select(*GROUP, "row_id")


def _pair_scores(pairs: DataFrame, dim: int) -> DataFrame:
    """Cosine of the two vectors of each pair, rounded half away from zero."""
    keep = [*GROUP, "row_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (matrix(batch.column(name), dim) for name in ("embedding", "asked"))
            scaled = np.einsum("pd,pd->p", one, two) / (np.linalg.norm(one, axis=1) * np.linalg.norm(two, axis=1)) * 10**PLACES
            score = np.copysign(np.floor(np.abs(scaled) + 0.5), scaled) / 10**PLACES + 0.0
            yield pa.RecordBatch.from_arrays([batch.column(name) for name in keep] + [pa.array(score)], names=[*keep, "score"])

    return pairs.mapInArrow(run, T.StructType([*[pairs.schema[name] for name in keep], T.StructField("score", T.DoubleType())]))


def knn_cells(idx: DataFrame, index: Cells, queries: DataFrame, k: int, probes: int | None = None, refine: int = REFINE) -> DataFrame:
    """Approximate top `k` rows of each index by cosine: `refine * k` candidates by their codes, scored with the vectors of `idx`.

    `idx` is the table that `index` was built from. With all cells probed only the codes can lose a row.
    """
    dim = index.centres.shape[1]
    near = settle(candidates(index, queries, refine * k, probes))
    asked = broadcast_if_small(settle(queries.select("query_id", F.col("embedding").alias("asked"))))
    rows = _usable(idx, dim).select("index_name", "row_id", "embedding")
    pairs = rows.join(broadcast_if_small(near), ["index_name", "row_id"]).join(asked, "query_id")
    return top_k(_pair_scores(pairs.select(*GROUP, "row_id", "embedding", "asked"), dim), k)


def scored_pairs(index: Cells, queries: DataFrame, k: int, probes: int | None = None, refine: int = REFINE) -> dict[str, int]:
    """How many pairs of a query and a row a search compares by codes and by vectors, and how many there are."""
    probes = min(probes or index.probes, len(index.centres))
    sizes = index.blocks.groupBy("cell").agg(F.sum(F.size("ids")).alias("n_rows"))
    asked = _packs(index, queries, probes).groupBy("cell").agg(F.sum(F.size("query_ids")).alias("n_queries"))
    by_code = sizes.join(asked, "cell").agg(F.coalesce(F.sum(F.col("n_rows") * F.col("n_queries")), F.lit(0))).first()[0]
    rows = index.blocks.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    exact = candidates(index, queries, refine * k, probes).count()
    return {"by_code": by_code, "exact": exact, "all": rows * _usable(queries, index.centres.shape[1]).count()}
