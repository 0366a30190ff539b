"""Language identification: kernel against sets, held-out accuracy, cases."""

import random
import zlib

import numpy as np
import pytest

from quillstream.llm import langid as op

SCHEMA = "doc_id bigint, text string, lang string, score string, column int"
WORDS = {"aa": "the and of this with that from".split(), "bb": "der und die nicht über schön zu".split(), "cc": "él año de la niño más y".split()}


def rows(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choices(WORDS[lang], k=rng.randint(3, 40))).capitalize(), lang, "x", 1))
    return out


def plain_grams(text):
    signs = [int(op._CLASS[b]) for b in text.encode()]
    return {tuple(signs[i : i + n]) for n in (1, 2, 3) for i in range(len(signs) - n + 1)}


def number(gram):
    return sum(64**k for k in range(1, len(gram))) + sum(sign * 64 ** (len(gram) - 1 - k) for k, sign in enumerate(gram))


def test_kernel_counts_common_ngrams(monkeypatch):
    monkeypatch.setattr(op, "SLICE_BYTES", 16)
    texts = [row[1] for row in rows(12)]
    for text in texts:
        assert set(np.concatenate(list(op.grams(text))).tolist()) == {number(g) for g in plain_grams(text)}
    samples = [(row[2], np.unique(np.concatenate(list(op.grams(row[1]))))) for row in rows(12)]
    model = op.fit(samples, per_language=2)
    marks = [plain_grams(text) for language in model.languages for text in [r[1] for r in rows(12) if r[2] == language][:2]]
    used = set().union(*marks)
    x = plain_grams(texts[0]) & used
    presence = np.zeros((1, len(model.landmarks)), dtype=np.float32)
    at = model.column[np.concatenate(list(op.grams(texts[0])))]
    presence[0, at[at >= 0]] = 1
    assert op.kernel(presence, model.landmarks)[0] == pytest.approx([len(x & m) / (len(x) * len(m)) ** 0.5 for m in marks], rel=1e-5)


def test_held_out_accuracy_and_cases(spark):
    table = rows(600) + [
        (9001, None, "aa", "x", 1), (9002, "", "aa", "x", 1), (9003, "12 ! 34", "aa", None, 1), (9004, "the and of this", None, "x", 1),
        (None, "der und die nicht", "bb", "x", None), (9005, "él año " * 200_000, "cc", "x", 1),
    ]
    frame = spark.createDataFrame(table + table[:3], SCHEMA)
    found = op.languages(frame).collect()
    assert len(found) == len(table) + 3
    truth = {row[0]: row[2] for row in table}
    for row in found:
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        if row.doc_id in (9001, 9002, 9003):
            assert (row.lang_pred, row.score) == ("und", 0)
    held = [row for row in found if row.held_out and row.doc_id < 600]
    assert np.mean([row.lang_pred == truth[row.doc_id] for row in held]) > 0.98
    by_id = {row.doc_id: row.lang_pred for row in found}
    assert (by_id[9004], by_id[None], by_id[9005]) == ("aa", "bb", "cc")
    kept = op.keep_identified(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted((r[0] or -1) for r in table + table[:3] if r[0] not in (9001, 9002, 9003))


def test_held_out_labels_are_never_read(spark):
    table = rows(300)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s, c) for i, t, lang, s, c in table]
    first, second = (sorted(map(tuple, op.languages(spark.createDataFrame(t, SCHEMA)).collect())) for t in (table, wrong))
    assert first == second


def test_nothing_to_learn_from(spark):
    assert op.languages(spark.createDataFrame([], SCHEMA)).count() == 0
    found = op.languages(spark.createDataFrame([(1, "text", None, "x", 1)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    unlabelled = [(1, "text", None, "x", 1), (2, None, None, "x", 1), (3, "12 _!", None, None, 1), (4, "él", None, "x", 1), (2, "b", "en", "x", 1)]
    held_out = [row for row in unlabelled if row[2] is None or zlib.crc32(str(row[0]).encode()) % 4 == 2]
    kept = op.keep_identified(spark.createDataFrame(held_out, SCHEMA))
    assert sorted(r.text for r in kept.collect()) == sorted(t for _, t, *_ in held_out if t and t != "12 _!")
    assert op.keep_identified(spark.createDataFrame([], SCHEMA)).count() == 0


def test_prediction_and_score_decide_what_stays(spark):
    frame = spark.createDataFrame(rows(300), SCHEMA)
    found = {r.doc_id: (r.lang_pred, r.score) for r in op.languages(frame).collect()}
    middle = sorted(score for _, score in found.values())[150]
    kept = {r.doc_id for r in op.keep_identified(frame, wanted=("aa", "cc"), least_score=middle).collect()}
    assert kept == {i for i, (name, score) in found.items() if name in ("aa", "cc") and score >= middle}
    assert 0 < len(kept) < 150
