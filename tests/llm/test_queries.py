"""Registered queries at the smallest scale: against their SQL, or against brute force over the same table."""

import hashlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from checks import compare
from quillstream.llm import oracle, queries
from quillstream.llm.pii import written
from tests.llm import test_pii, test_simhash

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text", "lang"])
    return {row["doc_id"]: row for row in table.to_pylist()}


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.no_truncation()
    return tokenizer


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_gives_what_its_sql_gives(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "SQL", oracle.SQL)
    assert compare.difference(spark, compare.oracle(SF_DIR), name, SF_DIR) is None


def rows(spark, name, texts):
    found = {row.doc_id: row for row in queries.QUERIES[name](spark, SF_DIR).collect()}
    assert found.keys() == texts.keys()
    return found


def test_op2(spark, texts):
    for doc_id, row in rows(spark, "op2_pii", texts).items():
        base = test_pii.plain(texts[doc_id]["text"] or "")
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(own) for own in base]
        assert row.base_sha256 == hashlib.sha256(written(base).encode()).hexdigest()
        assert set(written(base).split(",")) <= set(row.spans.split(","))


def test_op5(spark, texts):
    found = rows(spark, "op5_language", texts)
    held = [row for row in found.values() if row.held_out]
    assert {row.doc_id for row in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([row.lang_pred == texts[row.doc_id]["lang"] for row in held]) > 0.95


def test_op6(spark, texts, library):
    for doc_id, row in rows(spark, "op6_bpe", texts).items():
        ids = library.encode(texts[doc_id]["text"] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_op7(spark, texts):
    points = [(doc_id, test_simhash.plain_fingerprint(row["text"])) for doc_id, row in texts.items()]
    found = rows(spark, "op7_simhash", texts)
    assert [found[doc_id].fingerprint for doc_id, _ in points] == [f"{fp:016x}" for _, fp in points]
    assert [found[doc_id].component_id for doc_id, _ in points] == test_simhash.plain_components(points)


def test_op10(spark, texts, library):
    found, start = rows(spark, "op10_token_files", texts), 0
    for doc_id in sorted(texts):
        ids = library.encode(texts[doc_id]["text"] or "", add_special_tokens=False).ids + [1]
        row = found[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
