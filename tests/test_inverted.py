"""BM25 from stored postings, against the search that reads texts."""

import random

import pytest
from pyspark.sql import functions as F

from quillstream.operators import inverted, search
from quillstream.schemas import INDEX_ROW
from quillstream.session import settle
from quillstream.sources.change_log import ChangeLog

INDEX = "index_name string, row_id string, text string"
QUERIES = "query_id bigint, text string"


def hits(frame):
    return sorted(tuple(row) for row in frame.select("query_id", "index_name", "rank", "row_id", "score").collect())


@pytest.fixture(scope="module")
def corpus(spark):
    """Rows of words whose frequency falls with their number, in two indices, one of them with most rows."""
    rng = random.Random(6)
    words, often = [f"w{i}" for i in range(400)], [1 / (i + 1) for i in range(400)]

    def text(n):
        return " ".join(rng.choices(words, often, k=n))

    rows = [("big" if i % 9 else "small", f"r{i:05}", text(rng.choice([3, 8, 30, 200]))) for i in range(3000)]
    rows += [("big", "empty", ""), ("big", "none", None), ("big", "signs", "... !"), ("tiny", "one", "w0 w1")]
    rows += [("big", f"same{i}", "w3 w3 w7") for i in range(40)]
    queries = [(i, text(rng.choice([1, 2, 5, 12]))) for i in range(60)] + [(100, "nowhere"), (101, ""), (102, None), (103, "w399 w0 w0")]
    return settle(spark.createDataFrame(rows, INDEX).repartition(3)), spark.createDataFrame(queries, QUERIES)


@pytest.mark.parametrize("settings", [{}, {"BLOCK": 3, "SEEDS": 1}, {"LISTED_TERMS": 0, "BLOCK": 16}])
def test_hits_are_those_of_the_search_that_reads_texts(corpus, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(inverted, name, value)
    idx, queries = corpus
    index = inverted.build_inverted(idx)
    for k in (1, 7, 5000):
        assert hits(inverted.inverted_search(index, queries, k)) == hits(search.bm25_search(idx, queries, k))
    assert hits(inverted.inverted_search(index, queries, 3, 0.5, 0.2)) == hits(search.bm25_search(idx, queries, 3, 0.5, 0.2))


def test_blocks_that_cannot_reach_the_best_are_left_out(corpus, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 8)
    idx, queries = corpus
    index = inverted.build_inverted(idx)
    work = inverted.skipped_blocks(index, queries, 10)
    short = inverted.skipped_blocks(index, queries.where("text not like '% %'"), 10)
    print(work, short)
    assert 0 < work["skipped"] < work["asked"] and short["skipped"] >= 0.8 * short["asked"] > 0
    everything = inverted.skipped_blocks(index, queries, 100_000)
    assert everything["skipped"] == 0 and everything["asked"] == work["asked"]


def test_blocks_are_bounded_and_hold_every_posting_once(corpus, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 10)
    index = inverted.build_inverted(corpus[0])
    assert index.blocks.agg(F.max(F.size("ids"))).first()[0] == 10
    rows = index.blocks.select("index_name", "term", F.explode(F.arrays_zip("ids", "counts", "lengths")).alias("row"), "top_count", "least_length")
    assert rows.where("row.counts > top_count or row.lengths < least_length").isEmpty()
    found = rows.select("index_name", F.col("row.ids").alias("row_id"), F.col("row.lengths").alias("n_terms"), "term", F.col("row.counts").alias("tf"))
    wanted = search.postings(corpus[0]).select(*found.columns)
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_a_search_reads_no_text(spark, corpus, tmp_path):
    corpus[0].write.parquet(str(tmp_path / "texts"))
    index = inverted.build_inverted(spark.read.parquet(str(tmp_path / "texts")))
    plan = inverted.inverted_search(index, corpus[1], 5)._jdf.queryExecution().toString()
    assert "ids" in plan and str(tmp_path / "texts") not in plan
    scans = [line for line in plan.splitlines() if "FileScan" in line and "blocks" not in line and "term" in line and "ids" in line]
    assert scans and all("PushedFilters: [In(term" in line or "PushedFilters: [IsNotNull(" in line for line in scans)


def test_postings_are_dealt_out_by_number(corpus, monkeypatch):
    """However few partitions a session has, a task adds up and sorts a bounded number of postings."""
    index, queries = inverted.build_inverted(corpus[0]), corpus[1]
    asked = inverted._asked_blocks(index, queries, search.K1, search.B).agg(F.sum(F.size("ids"))).first()[0]
    monkeypatch.setattr(inverted, "TASK_POSTINGS", asked // 9)
    plan = inverted.inverted_search(index, queries, 5)._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.splitlines() if "RepartitionByExpression [index_name" in line and "row_id" in line]
    assert dealt and dealt[0].rstrip().endswith(", 10")


def test_empty_index(spark, corpus):
    index = inverted.build_inverted(corpus[0].where("false"))
    assert hits(inverted.inverted_search(index, corpus[1], 5)) == []


def test_postings_of_a_log_follow_its_snapshots(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"))
    queries = spark.createDataFrame([(1, "red fish"), (2, "bird")], QUERIES)
    columns = {f.name: F.lit(None).cast(f.dataType) for f in INDEX_ROW.fields}

    def batch(number, rows):
        data = spark.createDataFrame([("one", f"{doc}_0", doc, text) for doc, text in rows], "index_name string, row_id string, doc_id string, text string")
        arrival = F.struct(F.timestamp_micros(F.lit(number)).alias("timestamp"), F.lit(2).alias("rank"), F.lit(0).alias("partition"), F.lit(number).cast("bigint").alias("offset"))
        extra = {"chunk_id": F.lit(0), "arrival": arrival, "topic": F.lit("documents"), "partition": F.lit(0), "offset": F.lit(number)}
        wide = data.select("*", *[col.alias(name) for name, col in (columns | extra).items() if name not in data.columns])
        log.write("rows", number, wide.select("*", *[F.lit(None).alias(name) for name in ("status", "reason")]))
        log.commit(number)

    assert log.inverted() is None
    log.index_text()
    batch(0, [("a", "red fish"), ("b", "a bird"), ("c", "old fish")])
    log.compact()
    log.index_text()
    first = hits(inverted.inverted_search(log.inverted(), queries))
    assert first == hits(search.bm25_search(log.live(), queries)) and len(first) == 3
    batch(1, [("a", "a red bird"), ("d", "more fish")])
    assert hits(inverted.inverted_search(log.inverted(), queries)) == first
    log.compact()
    assert hits(inverted.inverted_search(log.inverted(), queries)) == first
    log.index_text()
    log.index_text()
    assert hits(inverted.inverted_search(log.inverted(), queries)) == hits(search.bm25_search(log.live(), queries)) != first
