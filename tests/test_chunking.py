import random

import pytest
from pyspark.sql import functions as F

from quillstream.functions.packing import chunk_spans
from quillstream.functions.text import split_sentences, split_words, strip
from quillstream.operators.chunking import chunk_text, long_sentence_windows, word_counts

CASES = [
    ("a b. c d.", ["a b. c d."]),
    ("a b c. d e f.", ["a b c.", "b c. d e f."]),
    ("a b c. d e f g h.", ["a b c.", "b c. d e f g h."]),
    ("a b c d e f g.", ["a b c d e", "d e f g.", "g."]),
    ("x. a b c d e f. y.", ["x.", "a b c d e", "d e f.", "y."]),
    ("v 3.14 is. ok", ["v 3.14 is. ok"]),
    ("a b.　c", ["a b. c"]),
    (" \n ", []),
    ("", []),
    (None, []),
    ("...", ["..."]),
    ("a?! b", ["a?! b"]),
]


def chunks(spark, texts, size, overlap):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [[] for _ in texts]
    for row in chunk_text(df, size, overlap).orderBy("doc_id", "chunk_id").collect():
        assert row["chunk_id"] == len(found[row["doc_id"]])
        assert row["n_words"] == len(row["text"].split(" "))
        found[row["doc_id"]].append(row["text"])
    return found


def test_hand_worked_cases(spark):
    assert chunks(spark, [text for text, _ in CASES], 5, 2) == [wanted for _, wanted in CASES]


@pytest.mark.parametrize("size, overlap", [(5, 5), (5, 6), (5, -1), (0, 0)])
def test_bad_window_fails_when_the_plan_is_built(spark, size, overlap):
    with pytest.raises(ValueError):
        chunk_text(spark.createDataFrame([("a",)], "text string"), size, overlap)


def test_overlap_zero_is_zero(spark):
    assert chunks(spark, ["a b c. d e f. g."], 4, 0) == [["a b c.", "d e f. g."]]


def test_spans_cover_every_word_within_the_bound():
    rng = random.Random(7)
    for _ in range(300):
        words = [rng.choice("abc") + rng.choice(["", "", "", ".", "!", "?"]) for _ in range(rng.randrange(0, 60))]
        size = rng.randrange(1, 12)
        overlap = rng.randrange(0, size)
        spans = chunk_spans(words, size, overlap)
        assert sorted({at for start, end in spans for at in range(start, end)}) == list(range(len(words)))
        assert all(0 < end - start <= size + overlap for start, end in spans)
        assert all(a[0] <= b[0] for a, b in zip(spans, spans[1:]))


def test_large_output_is_flushed_in_parts(spark):
    text = " ".join(f"w{n}" for n in range(400_000)) + "."
    df = spark.createDataFrame([("x", text)], "doc_id string, text string")
    row = chunk_text(df, 8, 7).agg(F.count("*"), F.max("chunk_id"), F.countDistinct("chunk_id")).first()
    assert tuple(row) == (400_000, 399_999, 400_000)


def test_words_and_sentences_follow_python_white_space(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
    text = spaces + "a.".join(spaces) + "​b﻿" + spaces
    df = spark.createDataFrame([(text,)], "text string")
    row = df.select(split_words("text"), strip(F.col("text")), split_sentences(F.col("text"))).first()
    assert row[0] == text.split()
    assert row[1] == text.strip()
    assert row[2] == text.split()


def test_word_counts_and_windows(spark):
    df = spark.createDataFrame([(1, "a b c d e f g. h i."), (2, " ")], "doc_id int, text string")
    assert [tuple(r) for r in word_counts(df).orderBy("doc_id").collect()] == [(1, 9, 2, 7), (2, 0, 0, 0)]
    windows = long_sentence_windows(df, 5, 2).orderBy("window_no").select("start", "length").collect()
    assert [tuple(r) for r in windows] == [(0, 5), (3, 4), (6, 1)]
