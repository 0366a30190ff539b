import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillstream.functions import hashing
from quillstream.functions.hashing import HashEmbedder, HashEmbedderFactory
from quillstream.functions.models import RetryPolicy, TransportError, embed_document, in_index_order
from quillstream.operators.embedding import (
    check_dim,
    chunk_and_embed,
    complete_documents,
    dim_report,
    embed,
    calls,
    order_by_index,
)


class Flaky:
    """Fails the first `failures` calls."""

    def __init__(self, failures, error=TransportError):
        self.left, self.error, self.calls = failures, error, 0

    def __call__(self, texts):
        self.calls += 1
        if self.left:
            self.left -= 1
            raise self.error("down")
        return [[float(len(t))] for t in texts]


def policy():
    waits = []
    return RetryPolicy(sleep=waits.append), waits


def test_two_failures_are_waited_out():
    retry, waits = policy()
    assert embed_document(["a", "bb"], Flaky(2), 10, retry) == [[1.0], [2.0]]
    assert waits == [2.0, 4.0]


def test_third_failure_is_final():
    retry, waits = policy()
    with pytest.raises(TransportError):
        embed_document(["a"], Flaky(3), 10, retry)
    assert waits == [2.0, 4.0]


def test_other_errors_are_not_tried_again():
    retry, waits = policy()
    model = Flaky(1, KeyError)
    with pytest.raises(KeyError):
        embed_document(["a"], model, 10, retry)
    assert (model.calls, waits) == (1, [])


def test_calls_hold_at_most_a_batch():
    model = Flaky(0)
    assert len(embed_document(["x"] * 21, model, 10, policy()[0])) == 21
    assert model.calls == 3


def test_missing_vector_fails_the_document():
    with pytest.raises(ValueError):
        embed_document(["a", "b"], lambda texts: [[1.0]], 10, policy()[0])


def test_index_order():
    assert in_index_order([{"index": 1, "embedding": [2]}, {"index": 0, "embedding": [1]}]) == [[1], [2]]


def test_order_by_index(spark):
    data = "array<struct<embedding:array<float>,index:int>>"
    df = spark.createDataFrame([("a", [([2.0], 1), ([1.0], 0), ([3.0], 2)])], f"doc string, data {data}")
    rows = order_by_index(df).orderBy("position").collect()
    assert [(r["position"], r["embedding"]) for r in rows] == [(0, [1.0]), (1, [2.0]), (2, [3.0])]


def failing_factory():
    """A factory made inside a function, which tasks get by value."""

    def factory():
        def model(texts):
            if any("bad" in t for t in texts):
                raise ValueError("bad text")
            return [[1.0, 2.0] for _ in texts]

        return model

    return factory


def test_failure_drops_its_document_only(spark):
    docs = spark.createDataFrame(
        [("good", "a b. c d. e f."), ("half", "a b. bad d. e f."), ("blank", " "), ("none", None)], "doc_id string, text string"
    )
    rows = chunk_and_embed(docs, failing_factory(), 2, 0, batch_size=1).orderBy("doc_id", "chunk_id").collect()
    assert [(r["doc_id"], r["chunk_id"], r["text"], r["error"]) for r in rows] == [
        ("blank", None, None, "no_chunks"),
        ("good", 0, "a b.", None),
        ("good", 1, "c d.", None),
        ("good", 2, "e f.", None),
        ("half", None, None, "embedding:ValueError"),
        ("none", None, None, "no_chunks"),
    ]
    assert {len(r["embedding"]) for r in rows if r["embedding"]} == {2}


def test_separate_steps_give_the_same(spark):
    chunks = spark.createDataFrame(
        [("good", 0, "a"), ("good", 1, "b"), ("half", 0, "a"), ("half", 1, "bad")], "doc_id string, chunk_id int, text string"
    ).coalesce(1)
    made = embed(chunks, failing_factory(), batch_size=1)
    assert made.where("error IS NOT NULL").count() == 2
    assert {r["doc_id"] for r in complete_documents(made).collect()} == {"good"}


def test_dimension_check_and_report(spark):
    rows = spark.createDataFrame(
        [("i", [1.0, 2.0], None), ("i", [1.0], None), ("i", None, "embedding:X")],
        "index_name string, embedding array<float>, error string",
    )
    assert sorted(str(r["error"]) for r in check_dim(rows, 2).collect()) == ["None", "dimension:1", "embedding:X"]
    registry = spark.createDataFrame([("i", 2)], "index_name string, dim int")
    assert sorted(str(r["error"]) for r in check_dim(rows.withColumn("own", F.lit(1)), "own").collect()) == ["None", "dimension:2", "embedding:X"]
    report = {r["dim"]: (r["n_rows"], r["matches"]) for r in dim_report(rows, registry).collect()}
    assert report == {2: (1, True), 1: (1, False)}


def test_batches_by_document(spark):
    """The model is called with ten texts of one document at most, and its answers are put in order."""
    docs = spark.createDataFrame([("a", "w. " * 25), ("b", "w. " * 3)], "doc_id string, text string")
    rows = chunk_and_embed(docs, recording_factory(), 1, 0, batch_size=10)
    recorded = rows.select("doc_id", "chunk_id", F.col("embedding")[0].cast("int").alias("n_texts"), F.col("embedding")[1].cast("int").alias("place"))
    found = calls(recorded).orderBy("doc_id", "batch_no").collect()
    assert [(r["doc_id"], r["n_texts"], r["first_chunk"], r["last_chunk"]) for r in found] == [
        ("a", 10, 0, 9), ("a", 10, 10, 19), ("a", 5, 20, 24), ("b", 3, 0, 2),
    ]


def recording_factory():
    def factory():
        return lambda texts: [{"index": i, "embedding": [len(texts), i]} for i in reversed(range(len(texts)))]

    return factory


def test_hash_vectors(spark):
    vector = HashEmbedder(16)(["Ab ab, cd_1 é"])[0]
    assert vector.dtype == np.float32
    assert np.isclose(np.linalg.norm(vector), 1)
    assert not HashEmbedder(16)(["..."])[0].any()
    df = spark.createDataFrame([("a", "Ab ab, cd_1 é")], "doc_id string, text string")
    assert embed(df, HashEmbedderFactory(16)).first()["embedding"] == vector.tolist()


def test_token_cache_is_bounded_and_keeps_vectors(monkeypatch):
    texts = [f"common word{n} {n}" for n in range(200)]
    wanted = HashEmbedder(16)(texts)
    monkeypatch.setattr(hashing, "_CACHE_LIMIT", 10)
    model = HashEmbedder(16)
    for text, vector in zip(texts, wanted):
        assert (model([text])[0] == vector).all()
        assert "common" in model._places or "common" in model._earlier
        assert len(model._places) <= 10 and len(model._earlier) <= 10


def test_chunks_are_handed_on_in_small_batches(spark):
    """A task holds the chunks of about a million characters, not of a whole batch of documents."""
    docs = spark.range(1).selectExpr("id AS doc_id", "'x' AS text")
    made = {}

    class Caught:
        columns, schema = docs.columns, docs.schema
        select = lambda self, *names: self
        mapInArrow = lambda self, run, schema: made.update(run=run)

    chunk_and_embed(Caught(), HashEmbedderFactory(8), 40, 10)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(60)), "text": ["word " * 20_000] * 60})
    sizes = [out.column("text").nbytes for out in made["run"](iter([batch]))]
    assert sum(sizes) > 6_000_000 and max(sizes) < 2_000_000
