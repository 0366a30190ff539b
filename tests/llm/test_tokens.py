"""Byte-pair encoding and token files against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import zstandard
from pyarrow import fs
from tokenizers import Tokenizer

from quillstream.llm import bpe, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, ids string, n_tokens string, row_key string"
TEXTS = [
    "The cat, the dog.", None, "", "  \n\t ", "<|endoftext|>x<|ENDOFTEXT|> <|startoftext|>", "it's they'll we'VE 12٣½",
    "ÀÉÎ Σίσυφος İstanbul ﬁ é", "a\x1cb\x85c d　e", "中文 \U0001f642‍՘", "a" * 3000, "the" * 900, "word " * 5000,
    "x\x00\x01y\x7fz~`!!!...,,", "The cat, the dog.",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def fuzz(n, seed=7):
    random.seed(seed)
    letters = "aabcceehit é'’sl<|endoftext|>\n.,!?12½ßΣσςİ̈Ａ中ก🙂"
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 50))) for _ in range(n)]


def rows(texts):
    return [(i, text, "x", None, "k") for i, text in enumerate(texts)]


def test_encoding_equals_the_library(spark, library):
    texts = TEXTS + fuzz(1500)
    docs = spark.createDataFrame(rows(texts), SCHEMA).repartition(3)
    found = {r.doc_id: r for r in bpe.encode(docs, PATH, texts=True, digests=True).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i].ids == " ".join(map(str, ids)), text
        assert (found[i].n_tokens, found[i].decoded) == (len(ids), decoded)
        assert found[i].ids_sha256 == hashlib.sha256(found[i].ids.encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
        assert bpe.decode(found[i].ids, PATH) == decoded


def test_small_cache_changes_nothing(library):
    cache = bpe.PieceCache(bpe._entries(bpe.merges(PATH)), limit=5)
    texts = fuzz(300, seed=8)
    for start in range(0, 300, 7):
        some = texts[start : start + 7]
        for text, (_, ids, _) in zip(some, bpe.encode_texts(some, cache)):
            assert ids == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))


def test_slices_equal_the_library(library):
    texts = [text or "" for text in TEXTS] + fuzz(800, seed=11) + ["", "ab\u2003c\u0085d\xa0\u3000e <|ENDOFTEXT|> \x1c", "Plain Text, only"]
    for width, size in ((2, 1), (2, 40), (4, 300)):
        cache = token_files._worker_cache.__wrapped__(PATH, width)
        for start in range(0, len(texts), size):
            some = texts[start : start + size]
            for text, ids in zip(some, token_files._ids_of(pa.array(some, pa.string()), cache, width), strict=True):
                assert np.frombuffer(ids.as_py(), f"<u{width}").tolist() == library.encode(text, add_special_tokens=False).ids + [1], text


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(docs, PATH).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(docs, PATH)).count() == 0


def test_files_give_back_the_ids(spark, library, monkeypatch):
    texts = TEXTS + fuzz(400, seed=9) + [" ".join(fuzz(6000, seed=10))]
    table = rows(texts) + [(3, "again", "x", None, "k"), (None, "no id", "x", None, "k")]
    random.shuffle(table)
    manifest = token_files.write_token_files(spark.createDataFrame(table, SCHEMA).repartition(5), PATH)
    found = token_files.read_token_files(manifest).orderBy("start").collect()
    start = 0
    written = [(doc_id, library.encode(text or "", add_special_tokens=False).ids + [1]) for doc_id, text, *_ in table]
    written.sort(key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    for row, (doc_id, ids) in zip(found, written, strict=True):
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), crc)
        start += len(ids)
    long_id = len(texts) - 1
    asked = {r.doc_id: r for r in token_files.lookup(manifest, [0, long_id, 10**9]).collect()}
    assert asked.keys() == {0, long_id}
    assert asked[long_id].ids == library.encode(texts[long_id], add_special_tokens=False).ids + [1]
    for path in [r.path for r in manifest.collect()]:
        store, local = fs.FileSystem.from_uri(path)
        data = store.open_input_file(local).read()
        reader = token_files.TokenReader(store.open_input_file(local))
        stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert len(stream) == reader.n_ids * reader.width  # any reader of the format unpacks it


def test_a_damaged_frame_is_noticed(tmp_path):
    path = tmp_path / "x.tokens"
    writer = token_files.TokenWriter(fs.LocalFileSystem().open_output_stream(str(path)), 2)
    for i in range(20):
        writer.add(i, np.full(9000, i, "<u2").tobytes())
    writer.close()
    reader = token_files.TokenReader(fs.LocalFileSystem().open_input_file(str(path)))
    assert [int(p[0]) for p in reader.pieces(19)] == [19] and reader.frames_read == 1
    reader.sums = reader.sums + 1
    reader.held = (-1, None)
    with pytest.raises(ValueError, match="damaged"):
        list(reader.pieces(3))
