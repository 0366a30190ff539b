"""Operator 13 against counting, document by document."""

from itertools import permutations

import numpy as np
import pytest

from quillstream.llm import filter_audit as audit
from quillstream.llm.common import join_unique

DOCS = "doc_id bigint, text string, source string, row_id string, part string"
LABELS = "doc_id bigint, quality int, toxic int"
LONG = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    (1, LONG, "a"),
    (2, LONG, "a"),  # a copy
    (2, LONG, "a"),  # the row again
    (3, LONG.upper(), "a"),
    (4, "one # sign", "a"),
    (5, "the same word " * 40, "b"),
    (6, None, "b"),
    (7, "", None),
    (None, LONG, "b"),
    (8, "\t\n \x0b", "b"),
    (9, LONG + "ünïcode" * 50_000 + " | " + "A" * 30_000, "b"),
    (10, "no break and space " * 30, ""),
]
MARKS = [(1, 1, None), (2, 1, 1), (2, 0, None), (6, None, 1), (None, 1, 1), (99, 1, 1)]


def plain(texts, labels):
    """Rows as the contract says, by going through all documents for each order."""
    items = []
    for doc_id, text, source in texts:
        own, words = text or "", (text or "").encode().split()
        copies = [i for i, other, _ in texts if i is not None and (other or "") == own]
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in own) > 5 * len(own),
            "D": any(c in "#$%&*|" for c in own),
            "E": doc_id is not None and min(copies) < doc_id,
        }
        marks = [mark for mark in labels if mark[0] is not None and mark[0] == doc_id]
        items.append((source or "", failed, any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    rows = {}
    for part in {item[0] for item in items}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [item for item in items if item[0] == part]
            for step, name in enumerate(order, 1):
                out = [item for item in left if item[1][name]]
                every = [item for item in items if item[0] == part and item[1][name]]
                left = [item for item in left if not item[1][name]]
                shapley[name] += len(out)
                only = sum(sum(item[1].values()) == 1 for item in every)
                lost = sum(item[2] for item in out), sum(item[3] for item in out)
                rows[part, "".join(order), step] = [len(left), len(out), len(every) - len(out), only, *lost, name]
        for key, row in rows.items():
            if key[0] == part:
                row[-1] = shapley[row[-1]]
    return {key: tuple(row) for key, row in rows.items()}


def found(spark, texts, labels, monkeypatch=None):
    docs = spark.createDataFrame([(*row, "x", "y") for row in texts], DOCS)
    rows = audit.filter_orders(docs, spark.createDataFrame(labels, LABELS)).collect()
    return {tuple(row[:3]): tuple(row[3:]) for row in rows}, len(rows)


def test_counts_are_those_of_all_documents(spark):
    rows, n = found(spark, TEXTS, MARKS)
    assert rows == plain(TEXTS, MARKS) and n == len(rows) == 3 * 600


def test_ranges_and_shuffled_joins_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(audit, "RANGE_BITS", 1)
    monkeypatch.setattr("quillstream.llm.common.BROADCAST_BYTES", 0)
    assert found(spark, TEXTS, MARKS)[0] == plain(TEXTS, MARKS)


def test_empty_tables(spark):
    assert found(spark, [], MARKS) == ({}, 0)
    assert found(spark, TEXTS, [])[0] == plain(TEXTS, [])


def test_lists(rng=np.random.default_rng(3)):
    for size, share in ((0, 1), (1, 2), (300, 1.1), (3000, 7), (3000, 900)):
        one, two = (np.unique(rng.integers(0, int(3000 * share), n)) for n in (size, 2000))
        for a, b in ((one, two), (two, one)):
            assert audit.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
            assert audit.union(a, b).tolist() == np.union1d(a, b).tolist()
            assert audit.difference(a, b).tolist() == np.setdiff1d(a, b).tolist()


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_join_of_common_and_null_keys(spark, monkeypatch, limit):
    monkeypatch.setattr("quillstream.llm.common.BROADCAST_BYTES", limit)
    rows = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0), (None, 0), (3, 0)], "k int, i int")
    side = spark.createDataFrame([(1, "one"), (3, "three"), (4, "four")], "k int, name string")
    joined = [(row.k, row.i, row.name) for row in join_unique(rows, side, "k", share=5).select("k", "i", "name").collect()]
    assert sorted(joined, key=repr) == sorted([(1, i, "one") for i in range(20)] + [(2, 0, None), (None, 0, None), (3, 0, "three")], key=repr)
