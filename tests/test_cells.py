"""Approximate search by cells and codes, against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.queries import DIM, K, row_queries, vector_index
from quillstream.operators import cells, search
from quillstream.session import settle

INDEX = "index_name string, row_id bigint, embedding array<float>"
QUERIES = "query_id bigint, embedding array<float>"


def rows(frame):
    return [tuple(row) for row in frame.select("query_id", "index_name", "row_id", "score", "rank").orderBy("query_id", "index_name", "rank").collect()]


def table(spark, vectors, name="one"):
    data = [(name, i, vector.tolist()) for i, vector in enumerate(vectors.astype(np.float32))]
    return settle(spark.createDataFrame(data, INDEX))


def asked(idx):
    return idx.where("row_id % 20 = 0").select(F.col("row_id").alias("query_id"), "embedding").distinct()


def recall(idx, queries, index, k, **how):
    found = cells.knn_cells(idx, index, queries, k, **how)
    return search.recall(search.knn_search(idx, queries, k, len(index.centres[0])), found).agg(F.sum("n_found") / F.sum("n_exact")).first()[0]


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_nine_of_ten_neighbours_with_a_tenth_of_the_pairs_scored(spark, scale):
    idx = settle(vector_index(spark, f"/root/testdata/{scale}"))
    queries, index = settle(row_queries(spark, f"/root/testdata/{scale}")), cells.build_cells(idx, DIM)
    work = cells.scored_pairs(index, queries, K)
    assert work["all"] == idx.count() * queries.count()
    assert work["exact"] <= work["all"] / 10
    assert recall(idx, queries, index, K) >= 0.9


def test_clustered_vectors_need_few_cells(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    idx = table(spark, centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 16)))
    index, queries = cells.build_cells(idx, 16), asked(idx)
    work = cells.scored_pairs(index, queries, 10)
    assert work["by_code"] <= 0.2 * work["all"] and work["exact"] <= 0.02 * work["all"]
    assert recall(idx, queries, index, 10) >= 0.9


def test_all_cells_and_enough_candidates_are_the_exact_search(spark, monkeypatch):
    """A cell that holds most rows, cut into small blocks and parts, and queries in small packs."""
    monkeypatch.setattr(cells, "BLOCK_ROWS", 7)
    monkeypatch.setattr(cells, "PACK_ROWS", 3)
    monkeypatch.setattr(cells, "PART_BLOCKS", 2)
    rng = np.random.default_rng(2)
    vectors = np.vstack([np.ones((150, 8)) + 0.01 * rng.normal(size=(150, 8)), rng.normal(size=(100, 8)), np.zeros((3, 8))])
    idx = table(spark, vectors).unionByName(table(spark, vectors[::2], "two"))
    index = cells.build_cells(idx, 8, cells=5)
    queries = asked(table(spark, vectors)).unionByName(spark.createDataFrame([(900, [0.0] * 8), (901, [1.0])], QUERIES))
    assert index.blocks.agg(F.max(F.size("ids"))).first()[0] <= 7
    assert index.parts.agg(F.max("parts")).first()[0] > 5
    assert index.blocks.agg(F.sum(F.size("ids"))).first()[0] == 250 + 125
    assert rows(cells.knn_cells(idx, index, queries, 5, probes=5, refine=100)) == rows(search.knn_search(idx, queries, 5, 8))


def test_the_filter_of_cells_changes_nothing(spark, monkeypatch):
    idx = table(spark, np.random.default_rng(4).normal(size=(400, 8)))
    index, queries = cells.build_cells(idx, 8), asked(idx)
    with_filter = rows(cells.knn_cells(idx, index, queries, 5, probes=2))
    monkeypatch.setattr(cells, "LISTED_CELLS", 0)
    assert rows(cells.knn_cells(idx, index, queries, 5, probes=2)) == with_filter


def test_no_rows_and_no_queries(spark):
    vectors = np.random.default_rng(3).normal(size=(30, 4))
    idx, queries = table(spark, vectors), asked(table(spark, vectors))
    nothing = cells.build_cells(idx.where("row_id < 0"), 4)
    assert rows(cells.knn_cells(idx.where("row_id < 0"), nothing, queries, 3)) == []
    assert rows(cells.knn_cells(idx, cells.build_cells(idx, 4), queries.where("query_id < 0"), 3)) == []
    assert rows(cells.knn_cells(idx, cells.build_cells(idx.where("row_id = 0"), 4), queries, 3))


def test_codes_are_off_by_half_a_step_at_most():
    for dim in (1, 2, 7, 64):
        units = cells._units(np.random.default_rng(dim).normal(size=(50, dim)))
        codes = cells.encode(units)
        assert len(codes) == 4 + 50 * ((dim + 1) // 2)
        assert np.abs(cells.decode(codes, dim) - units).max() <= np.abs(units).max() / 15 * 1.01
