import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from quillstream.operators import search
from quillstream.plans import sizing
from quillstream.session import settle

RNG = np.random.default_rng(5)
DIM, K = 6, 4


def rounded(x):
    return math.copysign(math.floor(abs(x) * 1e6 + 0.5), x) / 1e6


@pytest.fixture(scope="module")
def vectors(spark):
    """Two indices, one far larger; copies of one vector hold a third of the rows; one row has no direction, one a
    wrong dimension, one no vector."""
    same = RNG.normal(size=DIM).tolist()
    rows = [("big", f"r{n}", same if n % 3 == 0 else RNG.normal(size=DIM).tolist()) for n in range(600)]
    rows += [("small", f"s{n}", RNG.normal(size=DIM).tolist()) for n in range(3)]
    rows += [("big", "zero", [0.0] * DIM), ("big", "short", [1.0]), ("big", "none", None)]
    return rows, settle(spark.createDataFrame(rows, "index_name string, row_id string, embedding array<double>").select(
        "index_name", "row_id", F.col("embedding").cast("array<float>").alias("embedding")).repartition(5))


@pytest.fixture(scope="module")
def queries(spark, vectors):
    wanted = [(n, RNG.normal(size=DIM).tolist()) for n in range(7)] + [(7, [float(x) for x in vectors[0][0][2]])]
    extra = [(8, [0.0] * DIM), (9, [1.0])]
    return wanted, spark.createDataFrame(wanted + extra, "query_id bigint, embedding array<double>")


def brute_force(rows, queries, keep=lambda q, r: True):
    hits = {}
    for index in ("big", "small"):
        data = [(i, np.float32(v).astype(float)) for n, i, v in rows if n == index and v is not None and len(v) == DIM and any(v)]
        for query, vector in queries:
            q = np.array(vector)
            scored = [
                (-rounded(float(q @ v) / (np.linalg.norm(q) * np.linalg.norm(v))), i) for i, v in data if keep(q, v)
            ]
            hits[query, index] = [(i, -s) for s, i in sorted(scored)[:K]]
    return {key: found for key, found in hits.items() if found}


def collected(df):
    found = {}
    for row in df.orderBy("query_id", "index_name", "rank").collect():
        found.setdefault((row["query_id"], row["index_name"]), []).append((row["row_id"], row["score"]))
        assert row["rank"] == len(found[row["query_id"], row["index_name"]])
    return found


def assert_same(found, wanted):
    assert found.keys() == wanted.keys()
    for key in wanted:
        assert [i for i, _ in found[key]] == [i for i, _ in wanted[key]]
        assert np.allclose([s for _, s in found[key]], [s for _, s in wanted[key]], atol=1.1e-6)


def test_knn_is_exact(vectors, queries):
    assert_same(collected(search.knn_search(vectors[1], queries[1], K, DIM)), brute_force(vectors[0], queries[0]))


def test_knn_over_several_query_blocks_and_hand_overs(vectors, queries, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BYTES", 200)
    monkeypatch.setattr(search, "KEPT_HITS", 3)
    monkeypatch.setattr(search, "CELLS", 20)
    assert len(search._query_blocks(queries[1], DIM)) > 1
    assert_same(collected(search.knn_search(vectors[1], queries[1], K, DIM)), brute_force(vectors[0], queries[0]))


def test_lsh_scores_rows_that_share_a_bucket(vectors, queries):
    tables, bits = 3, 4
    near = search.with_lsh(vectors[1], DIM, tables, bits)

    def shares(q, v):
        return (search.lsh_buckets(q[None], tables, bits) == search.lsh_buckets(v[None], tables, bits)).any()

    found = search.knn_lsh(near, queries[1], K, DIM, tables, bits)
    assert_same(collected(found), brute_force(vectors[0], queries[0], shares))
    recall = search.recall(search.knn_search(vectors[1], queries[1], K, DIM), found)
    assert {r["query_id"] for r in recall.collect()} == set(range(8))
    assert all(0 < r["recall"] <= 1 for r in recall.collect() if r["query_id"] == 7)


TEXTS = [
    ("a", "a1", "Red fish, blue fish."), ("a", "a2", "One fish"), ("a", "a3", "..."), ("a", "a4", "red RED red green one two"),
    ("b", "b1", "fish"), ("b", "b2", "bird"),
]


def bm25(texts, query):
    scores = {}
    words = {i: "".join(c if c.isalnum() else " " for c in t.lower()).split() for _, i, t in texts}
    for index in {n for n, _, _ in texts}:
        mine = [i for n, i, _ in texts if n == index and words[i]]
        mean = sum(len(words[i]) for i in mine) / len(mine)
        for i in mine:
            score = 0.0
            for term in query:
                df = sum(term in words[j] for j in mine)
                tf = Counter(words[i])[term]
                if tf:
                    idf = math.log(1 + (len(mine) - df + 0.5) / (df + 0.5))
                    score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words[i]) / mean))
            if score:
                scores[index, i] = round(score, 6)
    return scores


def test_bm25(spark):
    idx = spark.createDataFrame(TEXTS, "index_name string, row_id string, text string")
    queries = spark.createDataFrame([(1, "Fish! red fish"), (2, "nothing here")], "query_id bigint, text string")
    rows = search.bm25_search(idx, queries, 10).collect()
    assert {(r["index_name"], r["row_id"]): r["score"] for r in rows} == bm25(TEXTS, ["fish", "red", "fish"])
    counts = {(r["row_id"], r["term"]): (r["tf"], r["n_terms"]) for r in search.postings(idx).collect()}
    assert counts["a1", "fish"] == (2, 4) and counts["a4", "red"] == (3, 6) and len(counts) == 11


def test_bm25_in_blocks_and_tiles_gives_the_same(spark, monkeypatch):
    idx = spark.createDataFrame(TEXTS, "index_name string, row_id string, text string")
    queries = spark.createDataFrame([(1, "Fish! red fish"), (2, "one two"), (3, ""), (4, "bird fish")], "query_id bigint, text string")
    wanted = collected(search.bm25_search(idx, queries, 2))
    for name, value in {"QUERY_BYTES": 100, "CELLS": 1, "KEPT_HITS": 1, "LISTED_TERMS": 0}.items():
        monkeypatch.setattr(search, name, value)
    assert collected(search.bm25_search(idx, queries, 2)) == wanted
    assert wanted.keys() == {(1, "a"), (1, "b"), (2, "a"), (4, "a"), (4, "b")}


def test_bm25_ties_go_to_the_lower_id(spark):
    rows = [("i", f"r{n:03}", "same words") for n in range(200)]
    idx = spark.createDataFrame(rows, "index_name string, row_id string, text string").repartition(4)
    queries = spark.createDataFrame([(1, "words")], "query_id bigint, text string")
    assert [i for i, _ in collected(search.bm25_search(idx, queries, 3))[1, "i"]] == ["r000", "r001", "r002"]


def test_fusion(spark):
    hits = "query_id bigint, index_name string, row_id string, score double, rank int"
    text = spark.createDataFrame([(1, "i", "x", 8.0, 1), (1, "i", "y", 4.0, 2), (1, "i", "z", 2.0, 3)], hits)
    near = spark.createDataFrame([(1, "i", "y", 0.9, 1), (2, "i", "x", 0.5, 1)], hits)
    found = collected(search.fuse(text, near, 2, weight=0.5))
    assert found == {(1, "i"): [("y", round(0.5 / 3 + 0.5, 6)), ("x", 0.5)], (2, "i"): [("x", 0.5)]}
    ranks = collected(search.fuse(text, near, 9, fusion="rrf"))
    assert ranks[1, "i"][0] == ("y", round(1 / 62 + 1 / 61, 6))
    with pytest.raises(ValueError):
        search.fuse(text, near, 2, fusion="sum")


def test_filters_and_look_ups(spark):
    rows = [("i", f"d_{n}", "d", n, "pdf" if n % 2 else "docx", None if n == 5 else "u") for n in range(12)] + [("i", " d_0", " d", 0, "pdf", "u")]
    idx = spark.createDataFrame(rows, "index_name string, row_id string, doc_id string, chunk_id int, source_type string, user_id string")
    ids = lambda df: sorted(r["row_id"] for r in df.collect())
    assert ids(search.filter_index(idx, source_type="pdf", chunk_id=(3, 7))) == ["d_3", "d_5", "d_7"]
    assert ids(search.filter_index(idx, chunk_id=(None, 0))) == [" d_0", "d_0"]
    assert ids(search.filter_index(idx, source_type=["pdf"], user_id=None)) == ["d_5"]
    assert len(ids(search.lookup_doc(idx, "i", "d"))) == 12
    assert ids(search.lookup_docs(idx, spark.createDataFrame([("i", " d"), ("j", "d")], "index_name string, doc_id string"))) == [" d_0"]
    first = [r["row_id"] for r in search.index_head(idx, "i").collect()]
    assert first == sorted(r[1] for r in rows)[:10]
    assert [r["row_id"] for r in search.index_heads(idx, 10).orderBy("position").collect()] == first


def test_size_checks(spark):
    df = spark.range(10).select("id", F.lit("abcd").alias("s"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    rows, size = sizing.measure(df)
    assert rows == 10 and size >= 10 * (8 + 4 + 16)
    assert "Broadcast" in df.join(sizing.broadcast_if_small(df, size), "id")._jdf.queryExecution().executedPlan().toString()
    assert sizing.broadcast_if_small(df, size - 1) is df


def test_spread_shuffles_small_sources_only(spark, tmp_path, monkeypatch):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert sizing.spread(df, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sizing, "source_bytes", lambda df: 1 << 50)
    assert sizing.spread(df, "id") is df


def test_packed_deals_by_bytes(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert sizing.packed(spark.range(100).repartition(40), "id").rdd.getNumPartitions() == cores
    monkeypatch.setattr(sizing, "source_bytes", lambda df: 9 * sizing.FILE_BYTES + 1)
    assert sizing.packed(spark.range(100), "id").rdd.getNumPartitions() == 10


def test_full_text_search_shuffles_only_the_best_of_each_task(spark):
    """Tokens and term counts stay where the text is, and a task hands on at most k rows of each query and index."""
    idx = spark.createDataFrame(TEXTS, "index_name string, row_id string, text string")
    assert "Exchange" not in search.postings(idx)._jdf.queryExecution().executedPlan().toString()
    terms = spark.createDataFrame([("fish",), ("red",)], "term string")
    assert "Exchange" not in search.term_counts(idx, terms)._jdf.queryExecution().executedPlan().toString()
    many = spark.range(3000).select(F.lit("i").alias("index_name"), F.concat(F.lit("r"), "id").alias("row_id"), F.lit("red fish").alias("text"))
    counts = settle(search.term_counts(many.repartition(3), terms))
    weights = search.term_weights(counts, terms.withColumn("query_id", F.lit(1)).withColumn("query_tf", F.lit(1))).collect()
    found = search._score_texts(counts, T.IntegerType(), weights, 5, 1.2, 0.75)
    assert found.count() <= 5 * counts.rdd.getNumPartitions()


def test_lsh_multiplies_only_pairs_that_share_a_bucket():
    tables, buckets = np.array([[0, 9], [1, 9]]), np.array([[0, 7], [1, 7], [2, 9], [0, 9], [3, 8]])
    query, row = search._sharing_pairs(tables, buckets)
    assert list(zip(query.tolist(), row.tolist())) == [(0, 0), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3)]
