"""Operator 11: spelling variants, by a frontier of states that walks a distributed trie.

Words are counted where the documents are read, and only counts are shuffled. The trie is a table of edges between its
branching nodes, one row by node and first letter, with the letters up to the next branching node; a node is known by a hash of
its prefix. A state (word, position, node, edits) says that the word, read up to the position with so many edits, leads to
the node. Level by level the states are joined with the edges of their nodes: an edge is followed if its letters are the
word's next ones, or entered with the one edit that its first letter asks for. A state that is at the end of its word and
of another word after one edit is a pair of near words.

Where two near words part, the edit can be taken to lie right there. So an edit is tried only on edges that leave the word's
own path; and only in the second half of a word, as a second trie of the words read backwards finds the other pairs. Near
the root, where all edges would have to be tried, states only follow their own path.

Nodes that over a thousandth of the words pass are `heavy`; they are fewer than a thousand for each length, and their
edges are broadcast if measured to be small. States of all other nodes are joined in a shuffle. Each level is written to the
checkpoint folder; a level has states only while words still share a branching node, however long the words are.

Cases: null and empty text has no words; a null doc_id is written as nothing before the colon; rows that repeat count again;
long texts are read slice by slice; of near words with the same count the smallest in code-point order is the form; an empty
table gives no row; other columns are not read. Letters above U+00FF end a word as other signs do. Node hashes have 64 bits and
are compared for words of the same prefix length only: with a thousand million words a false merge is to be expected in
one of some tens of runs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillstream.session import settle

from .common import cut, ints, rows_of, small

LEAST_LETTERS, LEAST_COUNT = 5, 3
MODULUS = 97
HELD_WORDS = 400_000  # of a task, before it hands their counts on
SLICE_BYTES = 1 << 20
ROOT = 2  # letters before the first node; no word is near another one by an edit before them and in its second half
HEAVY = 1000
AHEAD = 8  # letters that a state looks ahead

# A-Z become a-z, letters up to U+00FF stay, all else is a space; for bytes in Latin-1, where other letters became "?".
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def document_words(doc_id: int | None, text: str) -> Counter:
    """Counts of the words of one text in Latin-1, some of them with a letter deleted."""
    data, counts = text.encode("latin-1", "replace").translate(LETTERS), Counter()
    for piece in cut(data, SLICE_BYTES) if len(data) > SLICE_BYTES else [data]:
        counts.update(piece.split())
    start, out = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id), Counter()
    start = zlib.crc32(b":", start)
    for word, n in counts.items():
        if len(word) >= LEAST_LETTERS:
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
            if h % MODULUS == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < LEAST_LETTERS:
                    continue
            out[word] += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """Words with their numbers of occurrences, `word` and `n`."""

    def counted(counts: Counter) -> pa.RecordBatch:
        words = pa.array([word.decode("latin-1") for word in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, ints(list(counts.values()))], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in rows_of(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(document_words(doc_id, text))
            if len(held) > HELD_WORDS:
                yield counted(held)
                held.clear()
        yield counted(held)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = texts.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


# The trie


def _mixed(hashes: np.ndarray, letters: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ letters) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _prefixes(keys: DataFrame) -> DataFrame:
    """id, depth, node (hash of so many letters), the letter after them (0 at the end) and a CRC-32 of the next `AHEAD` letters,
    for each prefix of `ROOT` letters or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [key.encode("latin-1") for key in batch.column("key").to_pylist()]
            lengths = np.array([len(word) for word in words], np.int64)
            order = np.argsort(-lengths, kind="stable")
            letters = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
            starts, lengths = (np.cumsum(lengths) - lengths)[order], lengths[order]
            ids = batch.column("id").to_numpy()[order]
            texts = [words[i] if words[i].isascii() else None for i in order.tolist()]
            others = [None if text is not None else words[i].decode("latin-1") for i, text in zip(order.tolist(), texts)]
            nodes = _mixed(batch.column("side").to_numpy()[order].astype(np.uint64), np.uint64(1))
            for depth in range(int(lengths.max(initial=-1)) + 1):
                alive = int(np.searchsorted(-lengths, -depth, side="right"))
                if depth:
                    nodes = _mixed(nodes[:alive], letters[starts[:alive] + depth - 1] + np.uint64(2))
                if depth >= ROOT:
                    follows = int(np.searchsorted(-lengths, -(depth + 1), side="right"))
                    after = np.zeros(alive, np.int32)
                    after[:follows] = letters[starts[:follows] + depth]
                    stop = depth + AHEAD
                    ahead = [
                        zlib.crc32(text[depth:stop] if text is not None else other[depth:stop].encode())
                        for text, other in zip(texts[:alive], others[:alive])
                    ]
                    columns = [ints(ids[:alive]), ints(nodes[:alive].view(np.int64)), pa.array(np.full(alive, depth, np.int32)), pa.array(after), ints(ahead)]
                    yield pa.RecordBatch.from_arrays(columns, names=["id", "node", "depth", "letter", "ahead"])

    return keys.mapInArrow(run, "id bigint, node bigint, depth int, letter int, ahead bigint")


def _signed(ahead: Column, number: int) -> Column:
    """Bit of a CRC in the `number`-th of the four words of a node's signature, 0 in the others."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), ahead.bitwiseAND(63).cast("int"))
    return F.when(F.shiftright(ahead, 6).bitwiseAND(3) == number, bit).otherwise(F.lit(0).cast("bigint"))


def edge_table(keys: DataFrame) -> DataFrame:
    """The compact trie of keys(id, side, key): one row for each node and first letter, settled.

    `node`, `heavy` (of the node), `letter`, `label` (letters up to the next node, or to the end of the only word below), then `child`
    or `target`, the word that ends there. Of a child: `child_heavy`, and `signs`, 256 bits of which each word below has set one by the
    `AHEAD` letters that it goes on with.

    All words below an edge pass the next node, so edge and node have the same smallest id; they meet by it.
    """
    n = keys.count()
    letters = _prefixes(keys).groupBy("depth", "node", "letter").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), *[F.bit_or(_signed(F.col("ahead"), i)).alias(f"signs{i}") for i in range(4)]
    )
    nodes = settle(
        letters.groupBy("depth", "node")
        .agg(
            F.min("id").alias("id"),
            (F.sum("n") * HEAVY > n).alias("heavy"),
            F.collect_list("id").alias("below"),
            F.array(*[F.bit_or(f"signs{i}") for i in range(4)]).alias("signs"),
        )
        .where((F.size("below") > 1) | (F.col("depth") == ROOT))
    )
    step = F.struct("depth", "node", "heavy", "signs")
    paths = nodes.groupBy("id").agg(F.array_sort(F.collect_list(step)).alias("path"))
    ends = nodes.select("depth", "node", "heavy", F.explode("below").alias("id"))
    following = F.filter("path", lambda step: step["depth"] > F.col("depth"))
    joined = ends.join(paths, "id", "left").join(keys, "id").withColumn("next", F.try_element_at(following, F.lit(1)))
    length = F.coalesce(F.col("next.depth"), F.char_length("key")) - F.col("depth")
    return settle(
        joined.select(
            "node",
            "heavy",
            F.substring(F.col("key"), F.col("depth") + 1, F.lit(1)).alias("letter"),
            F.substring(F.col("key"), F.col("depth") + 1, length).alias("label"),
            F.col("next.node").alias("child"),
            F.col("next.heavy").alias("child_heavy"),
            F.col("next.signs").alias("signs"),
            F.when(F.col("next").isNull(), F.col("key")).alias("target"),
        )
    )


# The frontier


def _moves() -> Column:
    """What a state can do on an edge of its node: position and edits after it, null for a way that does not fit.

    An edge that has not the word's next letter is entered by an edit."""
    word, at, label = F.col("word"), F.col("position"), F.col("label")
    size, rest = F.char_length("label"), F.substring(F.col("label"), 2, 1 << 30)

    def fits(start: Column, letters: Column) -> Column:
        return F.substring(word, start + 1, F.char_length(letters)) == letters

    def move(condition: Column, position: Column, edits: Column) -> Column:
        return F.when(condition, F.struct(position.cast("int").alias("position"), edits.cast("int").alias("edits")))

    parts = F.col("letter") != F.col("next_letter")
    inside = at < F.char_length("word")
    return F.array(
        move(fits(at, label), at + size, F.col("edits")),
        move(parts & inside & (label != "") & fits(at + 1, rest), at + size, F.lit(1)),  # another letter
        move(parts & (label != "") & fits(at, rest), at + size - 1, F.lit(1)),  # one letter more
        move(parts & inside & fits(at + 1, label), at + 1 + size, F.lit(1)),  # one letter less
    )


STATE = ["word", "least", "backwards", "position", "node", "heavy", "edits"]


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """States one edge further; at the end of both words `target` has the near word, else it is null.

    A state after an edit goes on only if the signature of the child has the next letters of its word.
    """
    states = states.withColumn("next_letter", F.substring(F.col("word"), F.col("position") + 1, F.lit(1)))
    own, may_part = F.col("letter") == F.col("next_letter"), (F.col("edits") == 0) & (F.col("position") >= F.col("least"))
    joined = states.join(edges.withColumnRenamed("node", "of"), (F.col("node") == F.col("of")) & (own | may_part))
    moved = joined.withColumn("move", F.explode(_moves())).where("move is not null")
    left = F.char_length("word") - F.col("move.position")
    found = (F.col("move.edits") == 1) & (left == 0)
    ahead = F.crc32(F.encode(F.substring(F.col("word"), F.col("move.position") + 1, F.lit(AHEAD)), "UTF-8"))
    signs = F.get("signs", F.shiftright(ahead, 6).bitwiseAND(3).cast("int"))
    useful = (F.col("move.edits") == 0) | (F.getbit(signs, ahead.bitwiseAND(63).cast("int")) == 1)
    return moved.where(F.when(F.col("target").isNull(), useful).otherwise(found)).select(
        "word",
        "least",
        "backwards",
        F.col("move.position").alias("position"),
        F.col("child").alias("node"),
        F.col("child_heavy").alias("heavy"),
        F.col("move.edits").alias("edits"),
        "target",
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """`word` and `near` for all pairs of words(word) that differ by one edit, both ways; settled level by level."""
    both = words.select("word", F.lit(0).alias("side")).union(words.select(F.reverse("word"), F.lit(1)))
    keys = settle(both.select(F.monotonically_increasing_id().alias("id"), "side", F.col("word").alias("key")))
    edges = edge_table(keys)
    heavy = small(settle(edges.where("heavy").drop("heavy")))
    light = edges.where("not heavy").drop("heavy")
    half = F.char_length("key") / 2
    starts = _prefixes(keys).where(F.col("depth") == ROOT).select("id", "node").join(keys, "id")
    frontier = starts.join(edges.select("node", "heavy").distinct(), "node").select(
        F.col("key").alias("word"),
        F.when(F.col("side") == 0, F.floor(half)).otherwise(F.ceil(half)).cast("int").alias("least"),
        (F.col("side") == 1).alias("backwards"),
        F.lit(ROOT).alias("position"),
        "node",
        "heavy",
        F.lit(0).alias("edits"),
    )
    parts = []
    # partitions that were measured to be small are joined by hash, without a sort
    spark, setting = words.sparkSession, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(64 << 20))
    try:
        while not parts or not frontier.isEmpty():
            ahead = _advance(frontier.where("heavy").drop("heavy"), heavy).unionByName(_advance(frontier.where("not heavy").drop("heavy"), light))
            level = settle(ahead)
            parts.append(level.where("target is not null").select("word", "target", "least", "backwards"))
            frontier = level.where("target is null").select(*STATE)
    finally:
        spark.conf.set(setting, before)
    found = reduce(DataFrame.unionByName, parts)
    # of a word that parts from another one in both halves (a letter doubled across the middle), once
    word, near = (F.when(F.col("backwards"), F.reverse(name)).otherwise(F.col(name)) for name in ("word", "target"))
    first = F.floor(F.char_length("word") / 2).cast("int")
    twice = F.col("backwards") & (F.substring(word, F.lit(1), first) == F.substring(near, F.lit(1), first))
    return found.where(~twice).select(word.alias("word"), near.alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """`word` and `root` of forms(word, form): the last of the forms of forms. Counts double from each word to its form, so paths are short
    and are halved by each join of the table with itself."""
    now = settle(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        now = settle(moved)
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n."""
    words = settle(word_counts(docs))
    pairs = near_pairs(words)
    near = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("best")
    around = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    known = words.join(around, "word", "left")
    common = -F.col("best.n") >= 2 * F.col("n")
    forms = settle(
        known.select(
            "word",
            F.when(common, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(common, -F.col("best.n")).alias("form_n"),
        )
    )
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
