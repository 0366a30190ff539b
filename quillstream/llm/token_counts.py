"""Operator 1: token counts as rollups that are maintained by deltas.

A `TokenRollup` is a folder with three tables of one subfolder per batch. A batch of changes(doc_id, tokenizer, seq, op,
source, lang, n_docs, n_tokens) is committed like this; doc_id is any key of documents, kept as a string, and n_docs the
number of equal rows that the key stands for:

    state     what is known of each document and tokenizer version the batch touches, after it
    deltas    signed sums by source, lang and tokenizer: what was counted before goes out, what counts now comes in
    commits   the row that makes the batch visible

An `insert` or `revise` sets the count (and the source and language it counts for), a `delete` takes it out. Totals are
sums of deltas and never read a document again. Committing is idempotent twice over: a batch that is committed already is
left alone and one that broke off is written anew over its own folders, and an event whose seq is not beyond the one
known of its document and tokenizer changes nothing, in whatever batch it comes.

Changes are reduced to one row of each document and tokenizer before they meet the state, and signed rows are summed in
each task before the shuffle, so a source of any share costs as many rows as others. `compact` folds the state of all
batches into one, and the deltas too.

Cases: nulls in doc_id, source, lang or tokenizer are values like any other; a null n_tokens counts 0 tokens, a null n_docs one
document; a null op is an insert, a null seq comes before any other; of events with one seq the largest (op, n_tokens,
source, lang, n_docs) counts, so repeated events count once; a delete of what is not there is remembered but changes no total; groups without documents are
no rows; columns other than these are not read. Batches are committed in ascending order by one writer.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillstream.session import settle

from .common import row_key, rows_of

KEY = ("doc_id", "tokenizer")
GROUP = ("source", "lang", "tokenizer")
CARRIED = ("seq", "alive", "source", "lang", "n_docs", "n_tokens")
STATE = "doc_id string, tokenizer string, seq bigint, alive boolean, source string, lang string, n_docs bigint, n_tokens bigint"
DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
COMMITS = "committed boolean"
SCHEMAS = {"state": STATE, "deltas": DELTAS, "commits": COMMITS, "state_base": STATE, "deltas_base": DELTAS, "bases": COMMITS}

# Token counters that need no vocabulary, by version; `bpe.encode` gives the counts of a vocabulary. In each, a character
# by itself tells whether it is in no token, in a run that is one token, or a token alone; those beyond ASCII are in runs.
COUNTERS = {
    "space-1": r"[^\x20\x09-\x0D]+",
    "alnum-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
    "alnum-2": r"[0-9]|[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
}


NONE, RUN, ALONE = range(3)


def _kinds(pattern: str) -> bytes:
    """What each byte of UTF-8 is to a counter: as many tokens as two of it in a row make."""
    return bytes(RUN if byte > 127 else len(re.findall(pattern, chr(byte) * 2)) for byte in range(256))


def _n_tokens(texts: pa.Array, kinds: bytes) -> pa.Array:
    """Tokens of each text: those that begin between its first byte and that of the next text; null has none."""
    if not len(texts):
        return pa.array([], pa.int64())
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    kind = np.frombuffer(b"" if data is None else data.slice(at[0], at[-1] - at[0]).to_pybytes().translate(kinds), np.uint8)
    at = at - at[0]
    begins = kind != NONE
    begins[1:] &= (kind[1:] == ALONE) | (kind[:-1] != RUN)
    first = at[:-1][at[:-1] < len(kind)]
    begins[first] = kind[first] != NONE
    return pa.array(np.diff(np.searchsorted(np.flatnonzero(begins), at)), pa.int64())


def counted(text: Column, tokenizer: str) -> Column:
    """Tokens of a text by a counter, over the bytes of a batch at once: regexes in the JVM took twelve times as long."""
    kinds = _kinds(COUNTERS[tokenizer])

    @F.arrow_udf(T.LongType())
    def count(texts: pa.Array) -> pa.Array:
        pieces = rows_of(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))
        return pa.concat_arrays([_n_tokens(piece.column(0), kinds) for piece in pieces])

    return count(text)


def cleaned_of_digits(text: Column) -> Column:
    @F.arrow_udf(T.StringType())
    def clean(texts: pa.Array) -> pa.Array:
        return pc.replace_substring_regex(texts, "[0-9]+", "")

    return clean(text)


def changes(rows: DataFrame, op: str, seq: int, counts: dict[str, Column]) -> DataFrame:
    """One event for each of rows(doc_id, source, lang, ...) and tokenizer version, with its count, which is one of all
    `n_docs` rows where `rows` has that column."""
    n_docs = F.col("n_docs") if "n_docs" in rows.columns else F.lit(1)
    events = F.array(*[F.struct(F.lit(name).alias("tokenizer"), count.cast("bigint").alias("n_tokens")) for name, count in counts.items()])
    each = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "source", "lang", n_docs.cast("bigint").alias("n_docs"), F.explode(events).alias("event"))
    return each.select(
        "doc_id", "event.tokenizer", F.lit(seq).cast("bigint").alias("seq"), F.lit(op).alias("op"), "source", "lang", "n_docs", "event.n_tokens"
    )


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & left["tokenizer"].eqNullSafe(right["tokenizer"])


def _latest(state: DataFrame) -> DataFrame:
    """The last known row of each document and tokenizer."""
    last = F.max(F.struct(F.coalesce("seq", F.lit(-(1 << 62))).alias("at"), *CARRIED)).alias("last")
    return state.groupBy(*KEY).agg(last).select(*KEY, *[F.col(f"last.{name}") for name in CARRIED])


def _signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.select(*GROUP, (F.col("n_docs") * sign).alias("n_docs"), (F.col("n_tokens") * sign).alias("n_tokens"))


def _summed(deltas: DataFrame) -> DataFrame:
    sums = deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    return sums.filter((F.col("n_docs") != 0) | (F.col("n_tokens") != 0))


class TokenRollup:
    """Totals of tokens below one folder of a shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, table: str) -> DataFrame:
        schema = f"{SCHEMAS[table]}, batch bigint"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, table: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={batch}")

    def _last(self, table: str) -> int:
        last = self._read(table).agg(F.max("batch")).first()[0]
        return -1 if last is None else last

    def _visible(self, table: str, upto: int) -> DataFrame:
        """Rows up to a batch: the last compacted ones and those of the batches after them."""
        base = self._last("bases")
        rows = self._read(table).filter((F.col("batch") > base) & (F.col("batch") <= upto))
        return rows.unionByName(self._read(f"{table}_base").filter(F.col("batch") == base)).drop("batch")

    def commit(self, batch: int, events: DataFrame) -> bool:
        """Apply a batch; False if it was committed before."""
        last = self._last("commits")
        if batch <= last:
            return False
        n_docs = F.coalesce(F.col("n_docs").cast("bigint"), F.lit(1)) if "n_docs" in events.columns else F.lit(1).cast("bigint")
        event = F.struct(
            F.coalesce(F.col("seq").cast("bigint"), F.lit(-(1 << 62))).alias("at"), F.coalesce("op", F.lit("insert")).alias("op"),
            F.coalesce(F.col("n_tokens").cast("bigint"), F.lit(0)).alias("n_tokens"), F.col("source"), F.col("lang"), n_docs.alias("n_docs"),
            F.col("seq").cast("bigint").alias("seq"),
        )
        newest = events.groupBy(F.col("doc_id").cast("string").alias("doc_id"), "tokenizer").agg(F.max(event).alias("e"))
        new = settle(newest.select(*KEY, "e.seq", (F.col("e.op") != "delete").alias("alive"), "e.source", "e.lang", "e.n_docs", "e.n_tokens"))
        known = self._visible("state", last)
        old = _latest(known.join(new, _same_key(known, new), "left_semi"))
        late = new.alias("new").join(old.alias("old"), _same_key(new, old), "left").filter(
            F.col("old.alive").isNull() | (F.coalesce("new.seq", F.lit(-(1 << 62))) > F.coalesce("old.seq", F.lit(-(1 << 62))))
        )
        applied = settle(late.select("new.*", *[F.col(f"old.{name}").alias(f"old_{name}") for name in CARRIED[1:]]))
        out = applied.filter("old_alive").select("tokenizer", *[F.col(f"old_{name}").alias(name) for name in CARRIED[2:]])
        deltas = _signed(out, -1).unionByName(_signed(applied.filter("alive"), 1))
        self._write("state", batch, applied.select(*[field.split()[0] for field in STATE.split(", ")]))
        self._write("deltas", batch, _summed(deltas))
        self._write("commits", batch, self.spark.range(1).select(F.lit(True).alias("committed")))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all committed batches."""
        return _summed(self._visible("deltas", self._last("commits")))

    def compact(self) -> None:
        """Fold what the committed batches wrote into one state and one set of sums."""
        last = self._last("commits")
        if last > self._last("bases"):
            self._write("state_base", last, _latest(self._visible("state", last)))
            self._write("deltas_base", last, _summed(self._visible("deltas", last)))
            self._write("bases", last, self.spark.range(1).select(F.lit(True).alias("committed")))


def recount(rollup: TokenRollup, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A corpus's life in four batches: all documents come in; toxic ones go; those of low quality are cleaned of digits
    and counted anew, by a newer version of one tokenizer; then two of the batches are delivered again.

    A document is a row: rows are told apart by doc_id, text, source and language, and those that agree in all four are counted
    together, as so many documents of one key. A null doc_id has no label; a label without a toxic mark counts as not toxic."""
    # texts are counted where they are, as they came and cleaned; only counts meet the labels
    text, cleaned = F.col("text"), cleaned_of_digits(F.col("text"))
    key = F.concat_ws(":", row_key(), F.hex(F.xxhash64("source", F.col("source").isNull(), "lang", F.col("lang").isNull())))
    counts = [
        counted(text, "space-1").alias("space"), counted(text, "alnum-1").alias("alnum"),
        counted(cleaned, "space-1").alias("cleaned_space"), counted(cleaned, "alnum-2").alias("cleaned_alnum"),
    ]
    one_each = docs.select(F.col("doc_id").cast("bigint").alias("label_id"), key.alias("doc_id"), "source", "lang", *counts)
    names = one_each.columns[4:]
    alike = one_each.groupBy("label_id", "doc_id", "source", "lang", *names).agg(F.count(F.lit(1)).alias("n_docs"))
    rows = settle(alike.select("label_id", "doc_id", "source", "lang", "n_docs", *[(F.col(name) * F.col("n_docs")).alias(name) for name in names]))
    marks = settle(labels.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality")))
    toxic = rows.join(marks.filter("toxic = 1"), "label_id", "left_semi")
    poor = rows.join(marks.filter("quality = 0 and coalesce(toxic, 0) <> 1"), "label_id", "left_semi")
    none = F.lit(0)
    removed = changes(toxic, "delete", 2, {"space-1": none, "alnum-1": none})
    revised = (
        changes(poor, "revise", 3, {"space-1": F.col("cleaned_space")})
        .unionByName(changes(poor, "delete", 3, {"alnum-1": none}))
        .unionByName(changes(poor, "insert", 3, {"alnum-2": F.col("cleaned_alnum")}))
    )
    rollup.commit(0, changes(rows, "insert", 1, {"space-1": F.col("space"), "alnum-1": F.col("alnum")}))
    rollup.commit(1, removed)
    rollup.commit(2, revised)
    rollup.commit(1, removed)  # committed before: nothing happens
    rollup.commit(3, removed)  # a new batch of known events: no total changes
    rollup.compact()
    return rollup.totals()
