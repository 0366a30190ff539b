"""Operator 8: benchmark decontamination by suffix arrays over the training words.

Each task turns its documents, batch by batch, into arrays of word numbers and builds a suffix array over a batch: a
shard. Words that no benchmark item has get number 0, and only runs of benchmark words that are as long as the shortest
window enter the array, as no window can occur elsewhere; that leaves few positions, whatever the length of the texts.
All suffixes of the benchmark are then searched in the shard together: word by word, each keeps the range of the array
that agrees with it so far, narrowed by binary search. The depth a suffix reaches is its longest verbatim match, the
range its locations; the ranges at the window's length are the occurrences of the windows.

An item is cut into all its runs of 13 consecutive words; one of fewer, but not none, is a window itself. Words are runs
of ASCII letters and digits, A-Z lower-cased, and all characters beyond ASCII. A document is contaminated when the words
inside occurrences are at least a twentieth of its words.

The benchmark is searched in blocks of bounded size, each held by every task; the documents are read once per block.

Cases: null has no words, in either table; items without words match nothing; items with the same windows are all
counted; a null item_id is left out of the list of items but its windows count; repeated rows are judged alike; empty tables
give an empty result or clean documents; columns other than ids and texts are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillstream.session import settle

from .common import cut, drop_rows, ints, row_key, rows_of

WINDOW = 13
SHARE = 20  # contaminated from one hit word in so many
BLOCK_BYTES = 4 << 20  # of benchmark text that a task holds at once
SLICE_BYTES = 1 << 20  # of a text that is split into words at once

# ASCII letters are lowered, digits stay, other ASCII parts words; bytes from 0x80 on belong to words.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> Iterator[list[bytes]]:
    """Words of a text, slice by slice."""
    data = text.encode().translate(_TO_WORDS)
    if len(data) <= SLICE_BYTES:
        yield data.split()
    else:
        for part in cut(data, SLICE_BYTES):
            yield part.split()


class Benchmark(NamedTuple):
    """The suffixes of a block of items, with word numbers from 1."""

    numbers: dict[bytes, int]
    words: np.ndarray  # of all items, a 0 after each
    starts: np.ndarray  # of suffixes
    lengths: np.ndarray  # of suffixes, to the end of the item
    windows: np.ndarray  # length of the window that starts with the suffix, 0 if none
    items: np.ndarray  # item of the suffix
    least: int  # length of the shortest window


def index_items(items: list[tuple[int | None, str | None]], window: int = WINDOW) -> Benchmark:
    numbers: dict[bytes, int] = {}
    flat, starts, lengths, windows, owners = [], [], [], [], []
    for place, (_, text) in enumerate(items):
        words = [word for part in words_of(text or "") for word in part]
        n = len(words)
        for at in range(n):
            starts.append(len(flat) + at)
            lengths.append(n - at)
            windows.append(window if n - at >= window else n if at == 0 else 0)
            owners.append(place)
        flat.extend(numbers.setdefault(word, len(numbers) + 1) for word in words)
        flat.append(0)
    arrays = [np.array(column, dtype=np.int64) for column in (flat, starts, lengths, windows, owners)]
    used = arrays[3][arrays[3] > 0]
    return Benchmark(numbers, *arrays, int(used.min()) if len(used) else 0)


def suffix_array(words: np.ndarray, positions: np.ndarray, depth: int) -> np.ndarray:
    """`positions`, which are whole runs of words, in the order of the suffixes that start there, compared to `depth` words
    or the first 0, by doubling the length that is ranked."""
    rank = words.copy()  # by the first `step` words of each position
    step = 1
    order = positions[np.argsort(rank[positions], kind="stable")]
    while step < depth and len(order) > 1:
        # what stands at a position behind the first `step` words; 0 beyond the end or behind a break
        second = np.zeros(len(words), dtype=np.int64)
        second[:-step or None] = rank[step:]
        order = positions[np.lexsort((second[positions], rank[positions]))]
        a, b = rank[order], second[order]
        new = np.r_[1, 1 + np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))]
        fresh = np.zeros(len(words), dtype=np.int64)
        fresh[order] = new
        # behind a break there may be the rank of another run: it orders only suffixes that agree up to the break
        rank = fresh
        step *= 2
        if new[-1] == len(order):
            break
    return order


class Match(NamedTuple):
    suffix: np.ndarray  # number of the suffix of the benchmark
    low: np.ndarray  # range of the suffix array that holds it
    high: np.ndarray


def _bound(keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each wanted number within its own range of `keys`, all at once."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        value = keys[np.minimum(middle, len(keys) - 1)]
        up = open_ & ((value <= wanted) if right else (value < wanted))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def search(words: np.ndarray, order: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray, Match]:
    """Per suffix of the benchmark its longest match and one place of it, and the ranges of the windows that occur."""
    n = len(bench.starts)
    longest, place = np.zeros(n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    suffix = np.arange(n)
    low, high = np.zeros(n, dtype=np.int64), np.full(n, len(order), dtype=np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    depth = 0
    while len(suffix):
        going = bench.lengths[suffix] > depth
        suffix, low, high = suffix[going], low[going], high[going]
        if not len(suffix):
            break
        at = order + depth
        keys = np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0)
        wanted = bench.words[bench.starts[suffix] + depth]
        low, high = _bound(keys, low, high, wanted, False), _bound(keys, low, high, wanted, True)
        hit = low < high
        suffix, low, high = suffix[hit], low[hit], high[hit]
        depth += 1
        longest[suffix] = depth
        place[suffix] = order[low] if len(low) else 0
        whole = bench.windows[suffix] == depth
        if whole.any():
            found.append((suffix[whole], low[whole], high[whole]))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return longest, place, Match(empty, empty, empty)
    return longest, place, Match(*(np.concatenate(part) for part in zip(*found)))


def _positions(words: np.ndarray, least: int) -> np.ndarray:
    """Positions in runs of at least `least` benchmark words; the last of `words` is 0."""
    breaks = np.flatnonzero(words == 0)
    lengths = np.diff(np.r_[-1, breaks]) - 1
    return np.flatnonzero((words != 0) & np.repeat(lengths >= least, lengths + 1))


class Shard(NamedTuple):
    """What a batch of documents has in common with the benchmark."""

    counts: np.ndarray  # words of each document
    spans: list[list[tuple[int, int]]]  # merged spans of hit words
    items: list[list[int]]  # places of items with occurring windows
    longest: np.ndarray  # longest verbatim match of each document that starts an occurring window


def search_shard(texts: list[str], bench: Benchmark) -> Shard:
    get, parts, counts = bench.numbers.get, [], []
    for text in texts:
        n = 0
        for words in words_of(text):
            parts.append(np.fromiter([get(word, 0) for word in words], dtype=np.int64, count=len(words)))
            n += len(words)
        parts.append(np.zeros(1, dtype=np.int64))
        counts.append(n)
    words, counts = np.concatenate(parts), np.array(counts, dtype=np.int64)
    firsts = np.cumsum(counts + 1) - counts - 1
    empty = Shard(counts, [[] for _ in texts], [[] for _ in texts], np.zeros(len(texts), dtype=np.int64))
    if not bench.least:
        return empty
    positions = _positions(words, bench.least)
    if not len(positions):
        return empty
    order = suffix_array(words, positions, int(bench.lengths.max()))
    longest, _, match = search(words, order, bench)
    if not len(match.suffix):
        return empty
    # suffixes with the same window have the same range: expand each range once, items by range
    ranges, same = np.unique(np.stack([match.low, match.high, bench.windows[match.suffix]]), axis=1, return_inverse=True)
    same = same.reshape(-1)
    best = np.zeros(ranges.shape[1], dtype=np.int64)
    np.maximum.at(best, same, longest[match.suffix])
    owners: list[set[int]] = [set() for _ in range(ranges.shape[1])]
    for number, item in zip(same.tolist(), bench.items[match.suffix].tolist()):
        owners[number].add(item)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    items: list[set[int]] = [set() for _ in texts]
    out_longest = np.zeros(len(texts), dtype=np.int64)
    for number, (low, high, length) in enumerate(ranges.T.tolist()):
        at = order[low:high]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + length, -1)
        for doc in np.unique(np.searchsorted(firsts, at, side="right") - 1).tolist():
            items[doc] |= owners[number]
            out_longest[doc] = max(out_longest[doc], best[number])
    hit = np.cumsum(cover[:-1]) > 0
    edges = np.diff(np.r_[0, hit.astype(np.int8), 0])
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    for start, stop, doc in zip(starts.tolist(), stops.tolist(), (np.searchsorted(firsts, starts, side="right") - 1).tolist()):
        spans[doc].append((start - int(firsts[doc]), stop - int(firsts[doc])))
    return Shard(counts, spans, [sorted(own) for own in items], out_longest)


FOUND = "row_key string, doc_id bigint, n_words bigint, items array<bigint>, spans array<struct<start:bigint,stop:bigint>>, longest bigint"


def _search_block(keyed: DataFrame, items: list[tuple[int | None, str | None]], window: int) -> DataFrame:
    ids = [item_id for item_id, _ in items]
    bench = index_items(items, window)
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.int64()]
    names = ["row_key", "doc_id", "n_words", "items", "spans", "longest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            shard = search_shard(batch.column(2).to_pylist(), bench)
            found = [sorted({ids[i] for i in own if ids[i] is not None}) for own in shard.items]
            spans = [[{"start": a, "stop": b} for a, b in own] for own in shard.spans]
            data = [batch.column(0), batch.column(1), ints(shard.counts), pa.array(found, kinds[3]), pa.array(spans, kinds[4]), ints(shard.longest)]
            yield pa.RecordBatch.from_arrays(data, names=names)

    return keyed.mapInArrow(run, FOUND)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of bounded size; the number of blocks grows with the benchmark, what the driver holds does not."""
    items = settle(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for number in range(n):
        yield [(row.item_id, row.text) for row in items.filter(part == number).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: row_key, doc_id, n_words, n_hit, items with occurring windows, merged spans of hit words, the longest
    verbatim match at an occurring window, and `contaminated`."""
    keyed = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = [_search_block(keyed, items, window) for items in _blocks(benchmark, block_bytes)]
    found = blocks[0]
    if len(blocks) > 1:
        found = _merge(blocks)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["stop"] - span["start"])
    found = found.withColumn("n_hit", hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def _merge(blocks: list[DataFrame]) -> DataFrame:
    """One row for each row of the first block, with the matches of all."""
    first = settle(blocks[0])
    matched = first
    for block in blocks[1:]:
        matched = matched.unionByName(block)
    parts = matched.filter(F.size("spans") > 0)
    spans = (
        parts.groupBy("row_key").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("all_items"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("all_spans"),
            F.max("longest").alias("all_longest"),
        )
    )
    kind = "array<struct<start:bigint,stop:bigint>>"

    def join_up(done, span):
        last = F.try_element_at(done, F.lit(-1))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))))
        return F.when(F.coalesce(last["stop"] >= span["start"], F.lit(False)), grown).otherwise(F.concat(done, F.array(span)))

    merged = F.aggregate("all_spans", F.array().cast(kind), lambda done, span: join_up(done, span))
    joined = first.drop("items", "spans", "longest").join(spans, "row_key", "left")
    return joined.select(
        "row_key", "doc_id", "n_words",
        F.coalesce("all_items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce(merged, F.array().cast(kind)).alias("spans"),
        F.coalesce("all_longest", F.lit(0)).alias("longest"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (ids sorted as strings, comma-joined), contaminated."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, with the columns of `docs`."""
    found = settle(contamination(docs, benchmark).filter("contaminated").select("row_key").distinct())
    return drop_rows(docs, found)
