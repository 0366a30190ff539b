"""Token rollups against a plain replay of the events."""

import random
import re
import time

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quillstream.llm import bpe, token_counts as op
from quillstream.llm.oracle import SQL

EVENTS = "doc_id bigint, tokenizer string, seq bigint, op string, source string, lang string, n_tokens bigint, batch string"


def replayed(batches):
    low = -(1 << 62)
    state = {}
    for events in batches:
        best = {}
        for doc_id, tokenizer, seq, kind, source, lang, n in events:
            event = (low if seq is None else seq, kind or "insert", n or 0, source, lang)
            key = (doc_id, tokenizer)
            best[key] = max(best.get(key, event), event, key=lambda e: [str(x) if isinstance(x, str) else x if x is not None else "" for x in e])
        for key, event in best.items():
            if key not in state or event[0] > state[key][0]:
                state[key] = event
    totals = {}
    for (_, tokenizer), (_, kind, n, source, lang) in state.items():
        if kind != "delete":
            docs, tokens = totals.get((source, lang, tokenizer), (0, 0))
            totals[source, lang, tokenizer] = (docs + 1, tokens + n)
    return totals


def frame(spark, events):
    return spark.createDataFrame([(*e, "clash") for e in events], EVENTS)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_a_replay(spark, tmp_path, seed):
    rng = random.Random(seed)
    batches = [
        [
            (rng.choice([None, *range(6)]), rng.choice(["t1", "t2"]), rng.choice([None, *range(12)]), rng.choice(["insert", "revise", "delete", None]),
             rng.choice(["hot", "hot", "b"]), rng.choice(["en", "de"]), rng.choice([None, 1, 5, 9]))
            for _ in range(rng.randint(0, 25))
        ]
        for _ in range(4)
    ]
    rollup = op.TokenRollup(spark, str(tmp_path / "rollup"))
    for number, events in enumerate(batches):
        assert rollup.commit(number, frame(spark, events))
        if number == 2:
            rollup.compact()
        assert totals(rollup) == replayed(batches[: number + 1])
    assert not rollup.commit(2, frame(spark, batches[0]))
    assert rollup.commit(9, frame(spark, [e for batch in batches for e in batch if e[2] is not None]))
    assert totals(rollup) == replayed(batches)


def test_a_broken_batch_is_written_anew(spark, tmp_path, monkeypatch):
    rollup = op.TokenRollup(spark, str(tmp_path / "rollup"))
    rollup.commit(0, frame(spark, [(1, "t", 1, "insert", "s", "en", 5), (2, "t", 1, "insert", None, None, 7)]))
    write = op.TokenRollup._write

    def fail(self, table, batch, rows):
        if table == "commits":
            raise RuntimeError("lost")
        write(self, table, batch, rows)

    changed = frame(spark, [(1, "t", 2, "revise", "s", "de", 6), (2, "t", 2, "delete", None, None, None)])
    with monkeypatch.context() as patch:
        patch.setattr(op.TokenRollup, "_write", fail)
        with pytest.raises(RuntimeError):
            rollup.commit(1, changed)
    assert totals(rollup) == {("s", "en", "t"): (1, 5), (None, None, "t"): (1, 7)}
    assert rollup.commit(1, changed)
    assert totals(rollup) == {("s", "de", "t"): (1, 6)}


def test_counters_and_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b, c12", "s", "en"), (2, None, "s", "en"), (3, "é x", None, None)], "doc_id bigint, text string, source string, lang string")
    found = {(r.doc_id, r.tokenizer): r.n_tokens for r in op.changes(docs, "insert", 1, {t: op.counted(F.col("text"), t) for t in op.COUNTERS}).collect()}
    assert [found["1", t] for t in op.COUNTERS] == [3, 3, 5]
    assert [found["2", t] for t in op.COUNTERS] == [0, 0, 0]
    assert found["3", "space-1"] == 1
    rollup = op.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit(0, op.changes(docs.limit(0), "insert", 1, {"space-1": F.lit(1)}))
    rollup.compact()
    assert rollup.totals().count() == 0
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    total = op.recount(op.TokenRollup(spark, str(tmp_path / "other")), docs, labels).agg(F.sum("n_docs")).first()[0]
    assert total == 6


def test_counters_equal_their_regexes(spark):
    rng = random.Random(11)
    letters = [*map(chr, range(128)), *"  \n09aZ", "\u0085", "\u00a0", "é", "ß", "e\u0301", "中", "\u2028", "😀", "\ufffd"]
    texts = [None, "", " ", "7", "x", "é", *("".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    each = {
        **{name: op.counted(F.col("text"), name) for name in op.COUNTERS},
        **{f"cleaned {name}": op.counted(op.cleaned_of_digits(F.col("text")), name) for name in op.COUNTERS},
    }
    found = {row.doc_id: row for row in docs.select("doc_id", *[n.alias(name) for name, n in each.items()]).collect()}
    for doc_id, text in enumerate(texts):
        for name, pattern in op.COUNTERS.items():
            assert found[doc_id][name] == len(re.findall(pattern, text or "")), (name, text)
            assert found[doc_id][f"cleaned {name}"] == len(re.findall(pattern, re.sub("[0-9]+", "", text or ""))), (name, text)


def test_pieces_of_a_batch_and_texts_of_any_size(spark):
    sizes = [0, 5 << 20, 1, 3 << 20, 3 << 20, 0, 7]
    docs = spark.createDataFrame([(i, "ab 12 " * n) for i, n in enumerate(size // 6 for size in sizes)], "doc_id bigint, text string").coalesce(1)
    found = docs.select("doc_id", op.counted(F.col("text"), "space-1").alias("n"), op.counted(F.col("text"), "alnum-2").alias("m")).collect()
    assert [(r.n, r.m) for r in sorted(found)] == [(2 * (size // 6), 3 * (size // 6)) for size in sizes]


def test_counting_takes_far_less_than_a_regex_in_the_jvm(spark):
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.concat_ws("-", F.hex(i * 7919 + F.col("id")), F.lit("word"))))
    docs = spark.range(0, 1500, 1, 4).select("id", text.alias("text")).localCheckpoint()

    def seconds(count):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            docs.agg(*[F.sum(count(F.col("text"), name)) for name in op.COUNTERS]).collect()
            took.append(time.perf_counter() - start)
        return min(took)

    by_regex = seconds(lambda text, name: F.regexp_count(F.coalesce(text, F.lit("")), F.lit(op.COUNTERS[name])))
    assert seconds(op.counted) < by_regex / 2


def test_recount_equals_sql_on_repeated_and_null_ids(spark, tmp_path):
    rng = random.Random(5)
    texts = ["a b 12", "c", "c 3 d, e", None, ""]
    some = lambda values: rng.choice(values)
    docs = [(some([None, *range(8)]), some(texts), some(["s", "t", None]), some(["en", None])) for _ in range(120)]
    marks = [(some([None, *range(8)]), some([None, 0, 1]), some([None, 0, 1])) for _ in range(12)]
    frames = {
        "documents": spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string"),
        "labels": spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int"),
    }
    base = duckdb.connect()
    for name, df in frames.items():
        base.register(name, df.toArrow())
    expected = base.sql(SQL["op1_token_counts"]).fetchall()
    columns = [name for name, *_ in base.sql(SQL["op1_token_counts"]).description]
    rollup = op.TokenRollup(spark, str(tmp_path / "rollup"))
    found = op.recount(rollup, frames["documents"], frames["labels"]).select(*columns).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert sum(n for *_, n, _ in expected) > 100


def test_counts_of_a_vocabulary(spark, tmp_path):
    docs = spark.createDataFrame([(1, "The cat sat.", "s", "en"), (2, "unfathomable", "s", "en")], "doc_id bigint, text string, source string, lang string")
    counts = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), texts=False).select("doc_id", "n_tokens")
    rows = docs.join(counts, "doc_id")
    rollup = op.TokenRollup(spark, str(tmp_path / "rollup"))
    rollup.commit(0, op.changes(rows, "insert", 1, {"word_bpe_49k": F.col("n_tokens")}))
    expected = sum(r.n_tokens for r in counts.collect())
    assert totals(rollup) == {("s", "en", "word_bpe_49k"): (2, expected)}
