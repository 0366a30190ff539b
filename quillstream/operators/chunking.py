"""Text to overlapping chunks on sentence borders."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.arrow import FLUSH_CHARS, expand
from ..functions.packing import check_window, chunk_spans
from ..functions.text import split_sentences, split_words
from ..schemas import CHUNK_OVERLAP, CHUNK_SIZE


def chunk_text(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """One row per chunk of `text`: the other columns, then `chunk_id` from 0, `text` and `n_words`.

    Each break depends on the one before it, so packing runs once per document in an Arrow task; it needs no shuffle,
    and a blank text gives no row.
    """
    check_window(size, overlap)
    keep = [name for name in df.columns if name != "text"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, texts, counts, chars = [], [], [], [], 0

            def flush() -> pa.RecordBatch:
                extra = {
                    "chunk_id": pa.array(ids, pa.int32()),
                    "text": pa.array(texts, pa.string()),
                    "n_words": pa.array(counts, pa.int32()),
                }
                return expand(batch, keep, rows, extra)

            for row, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").split()
                for chunk_id, (start, end) in enumerate(chunk_spans(words, size, overlap)):
                    rows.append(row)
                    ids.append(chunk_id)
                    texts.append(" ".join(words[start:end]))
                    counts.append(end - start)
                    chars += len(texts[-1])
                    if chars >= FLUSH_CHARS:
                        yield flush()
                        rows, ids, texts, counts, chars = [], [], [], [], 0
            if rows:
                yield flush()

    schema = T.StructType(
        [df.schema[name] for name in keep]
        + [
            T.StructField("chunk_id", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("n_words", T.IntegerType()),
        ]
    )
    return df.select(*keep, "text").mapInArrow(pack, schema)


def sentences(df: DataFrame) -> DataFrame:
    """One row per sentence: the other columns, then `sentence_no` from 0, `sentence` and `n_words`."""
    keep = [name for name in df.columns if name != "text"]
    split = df.select(*keep, F.posexplode(split_sentences(F.col("text"))).alias("sentence_no", "sentence"))
    return split.withColumn("n_words", F.size(split_words(F.col("sentence"))))


def word_counts(df: DataFrame) -> DataFrame:
    """Words and sentences of each text, and the longest sentence, with built-in functions only."""
    keep = [name for name in df.columns if name != "text"]
    lengths = df.select(
        *keep,
        F.transform(split_sentences(F.col("text")), lambda s: F.size(split_words(s))).alias("_n"),
    )
    total = F.aggregate("_n", F.lit(0), lambda a, b: a + b)
    return lengths.select(
        *keep,
        total.alias("n_words"),
        F.size("_n").alias("n_sentences"),
        F.coalesce(F.array_max("_n"), F.lit(0)).alias("longest_sentence"),
    )


def sentence_windows(n_words: Column, size: int, overlap: int) -> Column:
    """Windows `(start, length)` over a sentence that is longer than `size`, as an array column."""
    check_window(size, overlap)
    starts = F.sequence(F.lit(0), n_words - 1, F.lit(size - overlap))
    return F.transform(
        starts, lambda s: F.struct(s.alias("start"), F.least(F.lit(size), n_words - s).alias("length"))
    )


def long_sentence_windows(df: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """The windows of every over-long sentence: `window_no`, `start` and `length` in words of the sentence."""
    long = sentences(df).where(F.col("n_words") > size)
    keep = [name for name in long.columns if name != "sentence"]
    windows = F.posexplode(sentence_windows(F.col("n_words"), size, overlap)).alias("window_no", "_w")
    return long.select(*keep, windows).select(*keep, "window_no", "_w.start", "_w.length")


def chunks_per_document(chunks: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("doc_id",)
    return chunks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_chunks"))
