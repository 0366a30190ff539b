"""Exact duplicates against a brute-force grouping."""

import hashlib
import random

import pytest

from quillstream.llm import exact_dedup as op

SCHEMA = "doc_id bigint, text string, lang string, row_key string, kept boolean"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(lowered(text), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        group = groups[lowered(text)]
        best = max(group, key=lambda i: (i is not None, i or 0))
        out.append((doc_id, best, len(group), hashlib.sha256(lowered(text).encode()).hexdigest()))
    return out


ROWS = [
    (1, "Same text", "en", "x", True),
    (5, "sAME TEXT", "en", None, None),
    (3, "same texT", None, "x", False),
    (2, None, "en", "x", True),
    (4, "", "en", "x", True),
    (6, "É", "en", "x", True),
    (7, "é", "en", "x", True),
    (8, "b" * 300_000, "en", "x", True),
    (9, "B" * 300_000, "en", "x", True),
    (10, "b" * 299_999 + "c", "en", "x", True),
    (None, "no id", "en", "x", True),
    (11, "twice", "en", "x", True),
    (11, "twice", "fr", "x", True),
    (11, "other", "fr", "x", True),
]


def check(spark, rows, hash_of=op.fingerprint):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = op.exact_duplicates(docs, hash_of).collect()
    order = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else v for v in r)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=order) == sorted(expected(rows), key=order)
    groups = {}
    for r in found:
        groups.setdefault(r.text_sha256, []).append(r)
    for group in groups.values():
        kept = [r for r in group if r.kept]
        assert len(kept) == 1 and kept[0].doc_id == kept[0].keep_id
    stays = op.drop_exact_duplicates(docs)
    assert stays.columns == docs.columns
    assert sorted(lowered(r.text) for r in stays.collect()) == sorted({lowered(r[1]) for r in rows})


def test_cases(spark):
    check(spark, ROWS)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert op.exact_duplicates(docs).count() == 0
    assert op.drop_exact_duplicates(docs).count() == 0


def test_equal_fingerprints_of_different_texts(spark, monkeypatch):
    monkeypatch.setattr(op, "ROWS_PER_SALT", 2)
    random.seed(5)
    rows = [(i, random.choice(["aa", "ab", "bA", "Bb", "ccc"]), "en", None, None) for i in range(40)]
    check(spark, rows, lambda data, weights: (0, 0))


@pytest.mark.parametrize("length", [0, 1, 4095, 4096, 4097, 20_000])
def test_parts_combine_to_the_whole(length):
    random.seed(length)
    data, weights = random.randbytes(length), op.powers(op.CHUNK_BYTES)
    whole = op.fingerprint(data, weights)
    for at in {0, length // 3, length}:
        assert op.combine(op.fingerprint(data[:at], weights), op.fingerprint(data[at:], weights), length - at) == whole
    value = 0
    for byte in data:
        value = (value * op.BASES[0] + byte) % op.PRIMES[0]
    assert whole[0] == value
