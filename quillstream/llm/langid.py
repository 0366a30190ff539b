"""Operator 5: language identification by string kernels.

The kernel of two texts is the number of n-grams of one to three signs that both hold, whatever their counts (the blended
spectrum by presence), divided by the roots of the two texts' own numbers. Signs are classes of bytes of the text in UTF-8:
the letters a to z without case, one for all other ASCII bytes, and 37 for bytes beyond ASCII. N-grams are those of the
landmarks.

Landmarks are some training texts of each language. A text is mapped to its kernel values with them, these by the
inverse root of the landmarks' own kernel matrix (Nystroem), and a ridge regression for each language against the rest is
solved on the mapped texts. To predict, the texts of a batch are a matrix of presence by n-gram: one product with the
landmarks gives the kernel values, another with the weights the scores.

Training takes a bounded sample, `PER_LANGUAGE` texts of each language, by the order of a hash of the text, so that a
language may hold any share of the rows. Only n-gram sets of the sample come to the driver. Whole texts are read, in slices.

Cases: a text that is null or has no letter is `und` with score 0; rows without a language or doc_id are not learned from;
without any row to learn from, all texts are `und`, and `keep_identified` keeps those with a letter; texts of equal scores get the first language in the alphabet; repeated
rows are judged alike; an empty table gives an empty result; columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from quillstream.session import settle

from .common import row_key, rows_of, small

PER_LANGUAGE = 400  # training texts of each language
LANDMARKS = 32  # of them, of each language
RIDGE = 1e-3
UNKNOWN = "und"
# A text whose best score is below resembles no language that was learned. Of the 10,000 texts of sf0.1 the least score is 0.156,
# that of a text of one word.
LEAST_SCORE = 0.05
SLICE_BYTES = 1 << 20  # of a text that is turned into n-grams at once
ROWS = 256  # texts of one matrix product
GRAMS = 64 + 64**2 + 64**3

# One class for ASCII beyond letters, 26 for letters, 37 for bytes from 0x80 on.
_CLASS = np.array([b - 64 if 65 <= b <= 90 else b - 96 if 97 <= b <= 122 else 27 + b % 37 if b >= 128 else 0 for b in range(256)], dtype=np.int32)
_LETTER = re.compile(r"[^\W\d_]")


def grams(text: str) -> Iterator[np.ndarray]:
    """Numbers of the n-grams of a text, with repeats, slice by slice; slices overlap so that none is lost."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    for start in range(0, max(1, len(data)), SLICE_BYTES):
        signs = _CLASS[data[start : start + SLICE_BYTES + 2]]
        yield signs
        if len(signs) > 1:
            pairs = signs[:-1] * 64 + signs[1:]
            yield pairs + 64
            if len(signs) > 2:
                yield pairs[:-1] * 64 + signs[2:] + (64 + 64**2)


class Model(NamedTuple):
    languages: list[str]
    column: np.ndarray  # of each n-gram in the presence matrix, -1 if no landmark has it
    landmarks: np.ndarray  # their presence, divided by the roots of their numbers
    weights: np.ndarray  # inverse root of the landmarks' kernel times the regressions' weights


def kernel(presence: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    own = np.sqrt(np.maximum(presence.sum(axis=1, keepdims=True), 1))
    return (presence @ landmarks) / own


def fit(samples: list[tuple[str, np.ndarray]], per_language: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """From texts as (language, distinct n-grams); the first of each language are the landmarks."""
    languages = sorted({language for language, _ in samples})
    chosen = [g for language in languages for g in [g for own, g in samples if own == language][:per_language]]
    used = np.unique(np.concatenate(chosen))
    column = np.full(GRAMS, -1, dtype=np.int32)
    column[used] = np.arange(len(used))

    def presence(sets: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(sets), len(used)), dtype=np.float32)
        for row, own in zip(out, sets):
            at = column[own]
            row[at[at >= 0]] = 1
        return out

    marks = presence(chosen)
    landmarks = (marks / np.sqrt(marks.sum(axis=1, keepdims=True))).T
    among = kernel(marks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    kept = values > 1e-6 * values.max()
    inverse_root = vectors[:, kept] / np.sqrt(values[kept])
    mapped = np.concatenate([kernel(presence([g for _, g in samples[at : at + ROWS]]), landmarks) for at in range(0, len(samples), ROWS)]) @ inverse_root
    targets = np.array([[1.0 if own == language else 0.0 for language in languages] for own, _ in samples])
    # classes of different sizes weigh the same
    balance = (1 / targets.sum(axis=0))[targets.argmax(axis=1)][:, None] * len(samples) / len(languages)
    solved = np.linalg.solve(mapped.T @ (mapped * balance) + ridge * len(samples) * np.eye(mapped.shape[1]), mapped.T @ (targets * balance))
    return Model(languages, column, landmarks.astype(np.float32), (inverse_root @ solved).astype(np.float32))


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1) of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
    for at in range(0, len(known), ROWS):
        some = known[at : at + ROWS]
        presence = np.zeros((len(some), len(model.landmarks)), dtype=np.float32)
        for row, i in zip(presence, some):
            for numbers in grams(texts[i]):
                place = model.column[numbers]
                row[place[place >= 0]] = 1
        outputs = kernel(presence, model.landmarks) @ model.weights
        best = outputs.argmax(axis=1)
        for i, language, score in zip(some, best.tolist(), outputs[np.arange(len(some)), best].tolist()):
            names[i], scores[i] = model.languages[language], min(1.0, max(0.0, score))
    return names, scores


def held_out() -> Column:
    """Rows that are never learned from; a null doc_id is not held out, but not learned from either."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray]]:
    """Distinct n-grams of up to `per_language` texts of each language, those of the least hash; at most 266,304 numbers a text."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out() & (F.coalesce(F.length("text"), F.lit(0)) > 0))
    hashed = settle(labelled.select("lang", F.xxhash64("text").alias("order")))
    # about four times the rows that are wanted lie below a language's threshold, so that a task hands on few rows of any
    # language; one that has too few texts there, as of copies, is ranked whole
    share = F.least(F.lit(1.0), F.lit(4.0 * per_language) / F.count(F.lit(1)))
    below = F.when(share >= 1, F.lit((1 << 63) - 1)).otherwise(((share - 0.5) * float(1 << 64)).cast("bigint"))
    limits = settle(hashed.groupBy("lang").agg(below.alias("below")))
    under = hashed.join(small(limits), "lang").filter("order <= below").select("lang", "order")
    few = settle(hashed.select("lang").distinct().join(under.distinct().groupBy("lang").count(), "lang", "left").filter(F.coalesce("count", F.lit(0)) < per_language).select("lang"))
    whole = hashed.join(small(few), "lang", "left_semi").unionByName(under.join(small(few), "lang", "left_anti"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    chosen = settle(whole.distinct().withColumn("rank", rank).filter(F.col("rank") <= per_language).select("lang", "order"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = [np.unique(np.concatenate(list(grams(text.as_py())))).astype(np.int32) for text in batch.column(2)]
            numbers = pa.array([g.tobytes() for g in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), numbers], names=["lang", "order", "grams"])

    texts = labelled.select("lang", F.xxhash64("text").alias("order"), "text").join(small(chosen), ["lang", "order"], "left_semi")
    sets = settle(texts.mapInArrow(run, "lang string, order bigint, grams binary")).dropDuplicates(["lang", "order"])
    rows = sets.orderBy("lang", "order").collect()
    return [(row.lang, np.frombuffer(row.grams, dtype=np.int32)) for row in rows]


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """row_key, doc_id, held_out, lang_pred, score of each row; one Arrow pass without a shuffle."""
    names = ["row_key", "doc_id", "held_out", "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            texts = batch.column(3).to_pylist()
            found, scores = predict(texts, model) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=names)

    rows = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "row_key string, doc_id bigint, held_out boolean, lang_pred string, score double")


def learn(docs: DataFrame) -> Model | None:
    samples = training_sample(docs)
    return fit(samples) if samples else None


def languages(docs: DataFrame) -> DataFrame:
    """Learn from the rows of `docs` that are not held out, and predict for all: doc_id, held_out, lang_pred, score."""
    return identify(docs, learn(docs)).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, wanted: Collection[str] | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """Rows whose text is in a language, with the columns of `docs`.

    A text stays if the score of its predicted language is `least_score` at least and, where `wanted` names languages, if
    that language is one of them. A text without a letter goes; with no row to learn from, all others stay.
    """
    model = learn(docs)
    if model is None:
        return docs.filter(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    columns, schema = docs.columns, docs.schema
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            names, scores = predict(batch.column(at).to_pylist(), model)
            stays = [name != UNKNOWN and score >= least_score and (wanted is None or name in wanted) for name, score in zip(names, scores.tolist())]
            kept = batch.filter(pa.array(stays, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=columns)

    return docs.mapInArrow(run, schema)
