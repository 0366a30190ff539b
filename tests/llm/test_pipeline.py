"""The pipeline against brute force, stage by stage."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_exact_dedup, test_simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, fp int"


@pytest.fixture
def tables(spark, tmp_path):
    rng = random.Random(11)
    words = {"en": "the and of this with that from house".split(), "de": "der und die nicht über schön zu haus".split()}

    def prose(lang, n):
        return " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "ing", "en", "er"]) for _ in range(n))

    rows = []
    for i in range(160):
        lang = rng.choice(["en", "de"])
        rows.append([i, prose(lang, rng.randint(20, 120)), lang, "hot" if i % 3 else "s", 1, "x", 1])
    items = [(i, prose("en", 30), "x") for i in range(4)] + [(7, None, "x")]
    for i in range(20):
        rows.append([200 + i, rows[i][1].upper(), "en", "s", 1, None, 2])  # exact copies
        rows.append([300 + i, rows[i + 30][1] + " tail", "en", "s", 1, None, 2])  # near copies
    rows += [[400, prose("en", 20) + " " + items[0][1], "en", "s", 1, "x", 1], [401, "12 34 !!", "en", "s", 1, "x", 1], [402, None, "en", "s", 1, "x", 1]]
    rows += [[403, "the and of this", None, None, None, None, None], list(rows[5]), [405, "house " * 20_000, "en", "s", 1, "x", 1]]
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string, doc_id string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, items, str(tmp_path)


def brute_force(rows, items):
    kept = [row for row in rows if any(c.isalpha() for c in row[1] or "")]
    last = {}
    for row in kept:
        key = test_exact_dedup.lowered(row[1])
        last[key] = max(last.get(key, row), row, key=lambda r: r[0])
    kept = list(last.values())
    points = [(row[0], test_simhash.plain_fingerprint(row[1])) for row in kept]
    kept = [row for row, component in zip(kept, test_simhash.plain_components(points)) if row[0] == component]
    dirty = {row[0] for row in test_decontaminate.expected([row[:2] for row in kept], items) if row[-1]}
    return [row for row in kept if row[0] not in dirty]


def test_rows_equal_brute_force(spark, tables):
    rows, items, folder = tables
    wanted = brute_force(rows, items)
    assert 100 < len(wanted) < len(rows)
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    tokenizer.no_truncation()
    found = {row.doc_id: row for row in corpus_pipeline.run(spark, folder).collect()}
    assert found.keys() == {row[0] for row in wanted}
    for doc_id, text, *_ in wanted:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns(spark, tables):
    _, _, folder = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).count() == 0  # rows are dropped, never changed


def test_empty_table(spark, tables, tmp_path):
    _, _, folder = tables
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty_after = stage(spark, empty, folder)
        assert empty_after.count() == 0
