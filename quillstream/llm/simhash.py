"""Operator 7: near-duplicates by SimHash fingerprints and pigeonring filtering.

A fingerprint has 64 bits; a bit is set if it is set in over half of the XXH64 hashes (seed 42) of all runs of four
words. Two fingerprints link at four or fewer differing bits, and documents of linked fingerprints form components.

The 64 bits lie on a ring of segments. If two fingerprints differ in at most t bits, then from some segment on every chain
of l consecutive segments differs in at most l * t / m bits in sum (m segments). The budgets of a chain name the
segments that are equal at least; each such choice is a key, and fingerprints that share a key are candidates. Candidates
have to hold the chain condition bit by bit before the full Hamming distance is taken.

Documents of one fingerprint are one node. Keys are grouped by a shuffle; a key of many fingerprints is cut into blocks,
and each pair of blocks is a unit of work of its own, so no task holds more than two blocks. Of a unit only the links of a
spanning forest are passed on, never all pairs.

Cases: null text has no words; no words give fingerprint zero, which links like any other; fewer than four words are one
run; repeated rows are rows of one component; a null doc_id is never the smallest; a component without ids has a null
component_id; an empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh64_intdigest

from quillstream.session import settle

from .common import cut, drop_rows, ints, one_of_repeated, row_key, rows_of, small
from .components import components

WORDS, SEED, MOST_BITS = 4, 42, 4
SLICE_BYTES = 1 << 20  # of a text that is split into words at once
BLOCK = 1000  # fingerprints of one key that are compared at once with as many others
CHUNK_ROWS = 60_000  # rows of many keys that a task works on at once


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of all runs of four words, or of all words if there are fewer."""
    text = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    stops = np.cumsum(lengths + 1) - 1
    first, last = (stops - lengths)[: max(1, len(words) - WORDS + 1)].tolist(), stops[min(WORDS, len(words)) - 1 :].tolist()
    return np.array([xxh64_intdigest(text[a:b], SEED) for a, b in zip(first, last)], dtype=np.uint64)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str) -> int:
    """Fingerprint as an unsigned number."""
    data = text.encode().lower()  # of bytes, so A-Z only
    counts, total, tail = np.zeros(64, dtype=np.int64), 0, []
    for part in cut(data, SLICE_BYTES, b" \t\n\v\f\r") if len(data) > SLICE_BYTES else [data]:
        words = tail + part.split()
        if len(words) >= WORDS:
            hashes = shingle_hashes(words)
            counts += _bit_counts(hashes)
            total += len(hashes)
            tail = words[1 - WORDS :]
        else:
            tail = words
    if not total:
        if not tail:
            return 0
        hashes = shingle_hashes(tail)
        counts, total = _bit_counts(hashes), len(hashes)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """row_key, doc_id and the fingerprint `fp` as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            found = np.array([fingerprint(text.as_py()) for text in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ints(found.view(np.int64))], names=["row_key", "doc_id", "fp"])

    keyed = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return keyed.mapInArrow(run, "row_key string, doc_id bigint, fp bigint")


def segments_for(fingerprints: int) -> tuple[int, int]:
    """Number of segments and length of the chains. More segments give longer keys, which keep groups small, and more of them;
    the links found are the same."""
    return (6, 4) if fingerprints < 1 << 26 else (8, 5) if fingerprints < 1 << 31 else (10, 7)


def borders(segments: int) -> list[int]:
    return [64 * i // segments for i in range(segments + 1)]


def chain_keys(segments: int, length: int, most: int = MOST_BITS) -> list[int]:
    """Masks of the segments that have to be equal: for each start on the ring and each way to spend the chain's budget."""
    edges = borders(segments)
    mask = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(segments)]
    budget = [(at + 1) * most // segments for at in range(length)]
    spent = budget[-1]
    masks = set()
    for unequal in combinations(range(length), spent):
        if all(sum(1 for u in unequal if u <= at) <= budget[at] for at in range(length)):
            for start in range(segments):
                masks.add(sum(mask[(start + at) % segments] for at in range(length) if at not in unequal))
    return sorted(masks)


def chain_holds(differing: np.ndarray, segments: int, length: int, most: int = MOST_BITS) -> np.ndarray:
    """Whether some chain of segments stays within its budgets, for each array element of differing bits."""
    edges = borders(segments)
    counts = [np.bitwise_count((differing >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int16) for a, b in zip(edges, edges[1:])]
    holds = np.zeros(len(differing), dtype=bool)
    for start in range(segments):
        total, fits = np.zeros(len(differing), dtype=np.int16), np.ones(len(differing), dtype=bool)
        for at in range(length):
            total = total + counts[(start + at) % segments]
            fits &= total <= (at + 1) * most // segments
        holds |= fits
    return holds


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of `n` by the links."""
    label = np.arange(n)
    while len(left):
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new
    return label


def links_within(unit: np.ndarray, block: np.ndarray, fp: np.ndarray, across: np.ndarray, segments: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of each unit; rows are sorted by unit. `across`: only pairs of different blocks count."""
    left, right = [], []
    at, step = np.arange(len(unit) - 1), 1
    while True:
        at = at[at + step < len(unit)]
        at = at[unit[at] == unit[at + step]]
        if not len(at):
            break
        pair = at[~across[at] | (block[at] != block[at + step])]
        differing = fp[pair] ^ fp[pair + step]
        near = chain_holds(differing, segments, length)
        pair, differing = pair[near], differing[near]
        pair = pair[np.bitwise_count(differing) <= MOST_BITS]
        left.append(pair)
        right.append(pair + step)
        step += 1
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    label = forest(len(unit), np.concatenate(left), np.concatenate(right))
    child = np.flatnonzero(label != np.arange(len(unit)))
    return child, label[child]


def _link_units(units: DataFrame, segments: int, length: int) -> DataFrame:
    """Links u, v of the units; rows come sorted by unit, which may reach over batches."""

    def work(rows: pa.Table) -> pa.RecordBatch:
        unit, block, low, high = (rows.column(name).to_numpy() for name in ("unit", "block", "low", "high"))
        fp = rows.column("fp").to_numpy()
        child, parent = links_within(unit, block, fp.view(np.uint64), low != high, segments, length)
        found = np.unique(np.stack([fp[child], fp[parent]]), axis=1)
        return pa.RecordBatch.from_arrays([ints(found[0]), ints(found[1])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < CHUNK_ROWS:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            unit = whole.column("unit").to_numpy()
            whole_units = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
            if whole_units:
                yield work(whole.slice(0, whole_units))
            held = whole.slice(whole_units).to_batches()
            rows = whole.num_rows - whole_units
        if rows:
            yield work(pa.Table.from_batches(held).combine_chunks())

    sorted_units = units.repartition("unit").sortWithinPartitions("unit", "block", "fp")
    return sorted_units.mapInArrow(run, "u bigint, v bigint")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keys(masks: list[int]) -> Column:
    return F.explode(F.array(*[F.xxhash64(F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")), F.lit(i)) for i, m in enumerate(masks)]))


def near_links(nodes: DataFrame) -> DataFrame:
    """Links u, v of a graph over nodes(fp), all different, whose components are those of all pairs within four bits."""
    segments, length = segments_for(nodes.count())
    keyed = nodes.select("fp", _keys(chain_keys(segments, length)).alias("key"))
    crowded = settle(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > BLOCK))
    parts = F.coalesce(F.ceil(F.col("size") / BLOCK), F.lit(1)).cast("int")
    blocked = keyed.join(small(crowded), "key", "left").select("fp", "key", parts.alias("parts"))
    blocked = blocked.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    paired = blocked.select("fp", "key", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    units = paired.select(F.xxhash64("key", low, high).alias("unit"), "block", low.alias("low"), high.alias("high"), "fp")
    return _link_units(units, segments, length)


def near_components(docs: DataFrame) -> DataFrame:
    """row_key, doc_id, fp and component_id (the smallest doc_id reachable) of each row; settled."""
    rows = settle(fingerprints(docs))
    nodes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(settle(near_links(nodes.select("fp"))))
    named = settle(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    components_of = named.join(least, "root").select("fp", "root", "component_id")
    return settle(rows.join(components_of, "fp").select("row_key", "doc_id", "fp", "root", "component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, fingerprint (16 lowercase hex digits), component_id."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_components(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, of the document of the smallest doc_id, with the columns of `docs`."""
    rows = near_components(docs)
    keys = settle(rows.groupBy("root", "row_key").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")))
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_key"))
    stays = settle(keys.groupBy("root").agg(F.min_by(F.struct("row_key", "rows"), order).alias("best")).select("best.*"))
    staying = drop_rows(docs, settle(keys.select("row_key").join(stays, "row_key", "left_anti")))
    return one_of_repeated(docs, staying, settle(stays.filter("rows > 1").select("row_key")))
