"""Operator 11 against comparing words by their single deletions."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from quillstream.llm import spelling

DOCS = "doc_id bigint, text string, word string, n bigint, node bigint"


def plain_words(rows):
    """Words that occur often enough, with their counts."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def plain_near(words):
    """Near words of each word: equal after one letter is left out, at the same place or of one of the two only."""
    left_out, near = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            left_out[word[:i], word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in left_out.values():
        for word in group:
            near[word] |= group - {word}
    return near


def plain_variants(words):
    near, forms = plain_near(words), {}
    for word, n in words.items():
        best = min(((-words[other], other) for other in near[word]), default=None)
        forms[word] = best[1] if best and -best[0] >= 2 * n else None
    rows = set()
    for word, form in forms.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.add((word, form, root, words[word], len(near[word]), words[form] if form else None))
    return rows


def variants(spark, rows):
    docs = spark.createDataFrame([(*row, "x", 1, 1) for row in rows], DOCS)
    found = spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len(set(found))
    return {tuple(row) for row in found}


def test_variants_of_crowded_words(spark):
    rng = np.random.default_rng(5)
    letters = "abAéÉ÷"
    words = ["".join(rng.choice(list(letters), rng.integers(4, 9))) for _ in range(300)]
    often = 1 / np.arange(1, 301)
    rows = [(i if i else None, " ".join(rng.choice(words, 400, p=often / often.sum())) + ("ā " if i % 2 else "\t42,")) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "tiny"), rows[5], rows[5]]
    wanted = plain_variants(plain_words(rows))
    assert len(wanted) > 100 and any(row[1] and row[2] != row[1] for row in wanted)
    assert variants(spark, rows) == wanted


def test_very_long_words_and_doubled_letters(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(3000))
    words = [long, long[:1500] + "z" + long[1500:], long[:2000] + "q" + long[2001:], long[1:], long + "e", long[:10] + long[11:]]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "abbba", "abbbba", "aabbba", "abcde", "abcdef", "xabcde", "bacde"]
    rows = [(i, " ".join(words * (i % 3 + 1))) for i in range(4)] + [(9, "aaaaa " * 100_000)]
    assert variants(spark, rows) == plain_variants(plain_words(rows))


def test_no_words(spark):
    assert variants(spark, []) == set()
    assert variants(spark, [(1, "one two"), (2, None)]) == set()
    assert variants(spark, [(1, "alone " * 5)]) == {("alone", None, "alone", 5, 0, None)}


def test_counts_handed_on_in_parts_and_shuffled_edges(spark, monkeypatch):
    rows = [(i, "letter lettre letters latter batter better bitter litter " * 3) for i in range(20)]
    monkeypatch.setattr(spelling, "small", lambda df: df)
    monkeypatch.setattr(spelling, "HEAVY", 3)
    assert variants(spark, rows) == plain_variants(plain_words(rows))


def test_edges_have_one_row_for_a_node_and_letter(spark):
    keys = spark.createDataFrame([(i, 0, word) for i, word in enumerate(["letter", "letters", "lettuce", "lever", "apple"])], "id bigint, side int, key string")
    edges = spelling.edge_table(keys).collect()
    assert len({(row.node, row.letter) for row in edges}) == len(edges)
    # two letters are the first node of each; "let" and "lett" have one way on, so the next node is "lett"
    assert sorted(row.label for row in edges) == sorted(["tt", "ver", "er", "uce", "", "s", "ple"])
    assert sorted(row.target for row in edges if row.target) == ["apple", "letter", "letters", "lettuce", "lever"]
    assert spelling.word_counts(spark.createDataFrame([(1, "Apple apple APPLE")], "doc_id int, text string")).where(F.col("word") == "apple").first().n == 3
