"""Registered queries against their SQL, at the smallest scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import queries
from checks.compare import difference, oracle
from checks.oracle import SQL, WITHOUT_SQL
from checks.queries import DIM, K, QUERIES, vector_index
from quillstream.operators import search
from quillstream.session import settle

SF_DIR = "/root/testdata/sf0.001"
# the rest runs with `python -m checks.compare`
NAMES = (
    "decode_messages", "parse_upload_time", "chunk_documents_small", "embedding_batches", "index_rows", "replace_document",
    "deletion_outcomes", "redelivered_index", "dim_report", "system_indices_ready", "bm25_search", "knn_lsh", "hybrid_search",
)


def test_every_query_has_sql():
    assert QUERIES.keys() - SQL.keys() == WITHOUT_SQL and SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_what_its_sql_gives(spark, name):
    assert difference(spark, oracle(SF_DIR), name, SF_DIR) is None


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_lsh_finds_nine_of_ten_neighbours(spark, scale):
    idx = settle(vector_index(spark, f"/root/testdata/{scale}"))
    queries = idx.where("row_id % 20 = 0").select(F.col("row_id").alias("query_id"), "embedding")
    found = search.knn_lsh(search.with_lsh(idx, DIM), queries, K, DIM)
    recall = search.recall(search.knn_search(idx, queries, K, DIM), found).agg(F.sum("n_found") / F.sum("n_exact"))
    assert recall.first()[0] >= 0.9


def test_lsh_search_reads_stored_buckets(spark):
    """A search of several blocks makes no bucket again, and its tasks hold one Python worker."""
    found = queries.knn_lsh_rows(spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert found.count("MapInArrow") == 1


def test_a_stream_gets_files_by_size_not_by_split(spark, tmp_path):
    rows = spark.range(400).selectExpr("'t' AS topic", "0 AS partition", "id AS offset", "timestamp_micros(id) AS timestamp", "'{}' AS value")
    source = queries._through_source(rows.repartition(40))
    assert len(spark.read.parquet(source.path).inputFiles()) <= spark.sparkContext.defaultParallelism
    assert spark.read.parquet(source.path).exceptAll(rows).isEmpty() and spark.read.parquet(source.path).count() == 400


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["query_id", "index_name", "row_id", "score", "rank"]
    assert found.count() > 0
