"""Operator 12: every row once, shards of even numbers, the same again for the same seed, in random order."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstream.llm import shards

DOCS = "doc_id bigint, text string, bucket int, place int, tags map<string,string>"


def docs(spark, n, parts=3):
    rows = [(i if i % 7 else None, None if i % 11 == 0 else f"text ü {i}" * (i % 5), 9, 9, {"a": "b"}) for i in range(n)]
    return spark.createDataFrame(rows, DOCS).repartition(parts, F.col("text")), rows


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 100, 1003])
def test_each_row_is_in_one_shard_and_counts_are_even(spark, n):
    table, rows = docs(spark, n)
    found = shards.shard_report(table).collect()
    wanted = [(i, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())) for i, text, *_ in rows]
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in found], key=repr) == sorted(wanted, key=repr)
    slots = [sorted(r.slot for r in found if r.shard == shard) for shard in range(shards.SHARDS)]
    assert all(own == list(range(len(own))) for own in slots)
    assert max(map(len, slots)) - min(map(len, slots)) <= 1 and sum(map(len, slots)) == n
    assert {(r.law, r.grown_shard) for r in found} <= {("rows", None)}


def test_repeated_rows_keep_a_slot_each(spark):
    table = spark.createDataFrame([(1, "same", 0, 0, None)] * 500 + [(2, None, 0, 0, None)] * 300, DOCS)
    found = shards.dealt(shards.shuffled_table(table)).collect()
    assert len({(r.shard, r.slot) for r in found}) == 800
    assert sum(r.doc.doc_id == 1 for r in found) == 500


def test_a_seed_gives_the_same_order_and_another_one_another(spark, tmp_path):
    docs(spark, 400)[0].write.parquet(str(tmp_path / "docs"))

    def order(seed):
        rows = shards.shuffled_table(spark.read.parquet(str(tmp_path / "docs")), seed)
        return {(r.doc.doc_id, r.doc.text): (r.shard, r.slot) for r in shards.dealt(rows).collect() if r.doc.doc_id}

    assert order(1) == order(1) != order(2)


def test_shards_can_be_read_one_by_one(spark):
    rows = shards.shuffled_table(docs(spark, 203)[0])
    manifest = shards.bucket_manifest(rows)
    slots = {(r.shard, r.slot): (r.doc.doc_id, r.doc.text) for r in shards.dealt(rows, 4).collect()}
    for shard in range(4):
        read = [(r.doc_id, r.text) for r in shards.read_shard(rows, manifest, shard, 4).collect()]
        assert read == [slots[shard, slot] for slot in range(len(read))]
    assert len(slots) == 203


def test_buckets_hold_the_bytes_asked_for(spark, tmp_path):
    docs(spark, 2000)[0].write.parquet(str(tmp_path / "docs"))
    table = spark.read.parquet(str(tmp_path / "docs"))
    rows = shards.shuffled_table(table, bucket_bytes=500)
    sizes = [r["count"] for r in rows.groupBy("bucket").count().collect()]
    assert len(sizes) > 20 and max(sizes) < 5 * np.mean(sizes)


def test_every_order_is_as_likely():
    counts = {}
    for seed in range(6000):
        order = tuple(shards.fisher_yates(3, np.random.default_rng(seed)).tolist())
        counts[order] = counts.get(order, 0) + 1
    assert len(counts) == 6 and min(counts.values()) > 850 and max(counts.values()) < 1150
    assert shards.fisher_yates(0, np.random.default_rng(0)).tolist() == []
