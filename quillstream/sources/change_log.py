"""The stored tables: a change log by batch, snapshots of the live index, and versions that make a batch visible.

Each table of a batch is written to a folder of its own, and a commit puts a version in place that names them (`manifest`). A
batch that is written again gets new folders that take the place of its old ones, so a replay after a crash changes nothing.
Folders of ten batches are folded into one, ten of those into one again, so a log of n batches has about ten times log10(n)
folders for each table, and a read opens those and lists no others. A snapshot takes the place of the rows it was made of.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.ids import index_kind
from ..operators.index_state import deletion_outcomes, live_stored_rows, of_last_version, stored, with_place
from ..operators.inverted import Inverted, build_inverted
from ..operators.search import filter_index
from ..operators.outcomes import last_outcomes
from ..schemas import DELETES, INDEX_ROW, OUTCOME, REGISTRY
from ..plans.sizing import broadcast_if_small
from ..session import settle, written
from .manifest import Manifest, Part, Version

_BATCH = T.StructField("batch_id", T.LongType())
_KEYED_ROW = T.StructType(
    [T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType())]
    + [T.StructField("offset", T.LongType())]
    + INDEX_ROW.fields
    # of marker rows for documents that went to no index
    + [T.StructField("status", T.StringType()), T.StructField("reason", T.ArrayType(T.StringType()))]
)
SCHEMAS = {
    "rows": _KEYED_ROW,
    "keys": T.StructType([INDEX_ROW[name] for name in ("index_name", "doc_id", "row_id", "arrival")]),
    "deletes": DELETES,
    "registry": REGISTRY,
    "outcomes": OUTCOME,
    "snapshot": INDEX_ROW,
    "postings": T.StructType(
        [T.StructField("index_name", T.StringType()), T.StructField("term", T.StringType()), T.StructField("ids", T.ArrayType(T.StringType()))]
        + [T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("counts", "lengths")]
        + [T.StructField(name, T.IntegerType()) for name in ("top_count", "least_length")]
    ),
    "sizes": T.StructType([T.StructField("index_name", T.StringType()), T.StructField("n_rows", T.LongType()), T.StructField("n_terms", T.LongType())]),
}
# Tables of every batch, whose folders are folded.
LOGGED = ("rows", "keys", "deletes", "registry", "outcomes")
# A read of a few documents skips the row groups whose filter of doc_id has none of them; filters grow with what they hold.
# Only the setting for all columns makes them grow: named for one column it is ignored, and each takes 1 MB.
BLOOM_FILTER = {"parquet.bloom.filter.enabled#doc_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
# Ranges that a snapshot is written in: the disk of its shuffle is cut by this number, and the log is read once more for each.
SLICES = 2
FOLD = 10  # folders of one level that are folded into one of the next


def _ranges(rows: DataFrame, slices: int, *keys: str) -> list[DataFrame]:
    """Rows of a stored table in ranges of the keys with about as many rows; all in one where the keys fill no two partitions."""
    key = F.struct(*keys)
    ranged = rows.select(*keys).repartitionByRange(*keys)
    found = settle(ranged.groupBy(F.spark_partition_id().alias("_part")).agg(F.min(key).alias("_least"), F.count(F.lit(1)).alias("_n"))).orderBy("_part").collect()
    total, before, least = sum(r["_n"] for r in found), 0, [None]
    for r in found:
        if before * slices >= total * len(least) and r is not found[0]:
            least.append(F.struct(*[F.lit(r["_least"][name]).cast(rows.schema[name].dataType).alias(name) for name in keys]))
        before += r["_n"]
    conditions = [reduce(lambda a, b: a & b, [key >= low] * (low is not None) + [key < high] * (high is not None), F.lit(True)) for low, high in zip(least, [*least[1:], None])]
    return [rows.where(condition) for condition in conditions]


class ChangeLog:
    """Tables below one folder of a shared file system, written by one streaming query at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._manifest = Manifest(spark, self.path)
        self._staged: dict[tuple[str, int], Part] = {}

    def _write(self, table: str, df: DataFrame, first: int, last: int, level: int = 0) -> Part:
        """Write to a new folder, which nobody sees before a version names it."""
        folder = f"{table}/{first}-{last}-{uuid.uuid4().hex}"
        written(df, f"{self.path}/{folder}", **BLOOM_FILTER if "doc_id" in df.columns else {})
        return Part(folder, first, last, level)

    def write(self, table: str, batch_id: int, df: DataFrame) -> None:
        """Write one table of a batch; `commit` makes it visible."""
        shaped = df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields], F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._staged[table, batch_id] = self._write(table, shaped, batch_id, batch_id)

    def commit(self, batch_id: int) -> None:
        """Make what was written of a batch visible at once, in place of an earlier try."""
        staged = {table: part for (table, batch), part in self._staged.items() if batch == batch_id}

        def change(old: Version) -> Version:
            kept = {}
            for table, part in staged.items():
                if any(p.level and p.first <= batch_id <= p.last for p in old.of(table)):
                    raise ValueError(f"batch {batch_id} of {self.path} was folded: only the last batch can come again")
                kept[table] = [p for p in old.of(table) if (p.first, p.last) != (batch_id, batch_id)] + [part]
            return replace(old.with_parts(**kept), committed=max(old.committed, batch_id))

        self._manifest.publish(change)
        self._staged = {}

    def _last(self, what: str) -> int:
        version = self._manifest.current()
        return {"commits": version.committed, "compactions": version.compacted, "indexed": version.indexed}[what]

    def _frame(self, table: str, parts: Iterable[Part]) -> DataFrame:
        schema = T.StructType([*SCHEMAS[table].fields, _BATCH])
        paths = [f"{self.path}/{part.folder}" for part in parts]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @staticmethod
    def _parts(version: Version, table: str, above: int | None, upto: int) -> list[Part]:
        return [p for p in version.of(table) if p.first <= upto and (above is None or p.last > above)]

    def _between(self, version: Version, table: str, above: int | None, upto: int, **wanted) -> DataFrame:
        """Rows of the batches after `above` and up to `upto` that meet the conditions (`filter_index`)."""
        found = filter_index(self._frame(table, self._parts(version, table, above, upto)), **wanted).where(F.col("batch_id") <= upto)
        return found if above is None else found.where(F.col("batch_id") > above)

    def read(self, table: str, upto: int | None = None) -> DataFrame:
        """Committed batches of a table. `upto` reads further, to a batch that is being written by this very object."""
        version = self._manifest.current()
        if upto is None:
            return self._between(version, table, None, version.committed)
        own = [part for (name, batch), part in self._staged.items() if name == table and batch <= upto]
        again = {(part.first, part.last) for part in own}
        ahead = version.with_parts(**{table: [p for p in version.of(table) if (p.first, p.last) not in again] + own})
        return self._between(ahead, table, None, upto)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """One batch, also one that is being written by this object."""
        own = self._staged.get((table, batch_id))
        parts = [own] if own else [p for p in self._manifest.current().of(table) if p.first <= batch_id <= p.last]
        return self._frame(table, parts).where(F.col("batch_id") == batch_id)

    def registry(self, upto: int | None = None) -> DataFrame:
        """One row per index, the earliest request winning; a request later in time can be in an earlier batch."""
        rows = self.read("registry", upto)
        return (
            rows.groupBy("index_name")
            .agg(F.min("created").alias("created"), F.min("dim").alias("dim"))
            .select("index_name", index_kind(F.col("index_name")).alias("kind"), "dim", "created")
        )

    def deletion_outcomes(self) -> DataFrame:
        """What each deletion of the committed batches did; reads keys of the rows, no text and no vector."""
        return deletion_outcomes(self.read("deletes").drop("batch_id").distinct(), self.registry(), self.read("keys").drop("batch_id"))

    def judged_deletions(self, batch_id: int) -> DataFrame:
        """What deletions did, for those that the batch that is being written brings or may change the answer of.

        These are the deletions of all documents that the batch deletes or writes, and of those in an index that it makes:
        a write or a deletion that comes late in the stream is judged by its own time. Only keys are read.
        """
        deletes = self.read("deletes", batch_id).drop("batch_id").distinct()
        key = ["index_name", "doc_id"]
        moved = self.batch("deletes", batch_id).select(*key).unionByName(self.batch("keys", batch_id).select(*key)).distinct()
        made = self.batch("registry", batch_id).select("index_name").distinct()
        touched = deletes.join(moved, key, "left_semi").unionByName(deletes.join(broadcast_if_small(made), "index_name", "left_semi"))
        asked = settle(touched.distinct())
        documents = broadcast_if_small(settle(asked.select(*key).distinct()))
        writes = self.read("keys", batch_id).drop("batch_id").join(documents, key, "left_semi")
        return deletion_outcomes(asked, self.registry(batch_id), writes)

    def outcomes(self) -> DataFrame:
        """One outcome for each message of the committed batches, the last that was found: a deletion's is revised when a write
        or a creation from before it comes in a later batch, and a message that is delivered again has one outcome."""
        return last_outcomes(self.read("outcomes"))

    def claim(self, query_id: str) -> None:
        """Bind the log to one streaming query; another one, whose batch numbers mean other messages, is refused."""
        owner = self._manifest.publish(lambda old: old if old.owner else replace(old, owner=query_id)).owner
        if owner != query_id:
            raise ValueError(f"{self.path} belongs to another checkpoint: its batches would be overwritten")

    def seed(self, rows: DataFrame) -> None:
        """Registry rows that belong to no batch of messages, each time in a new folder below batch 0."""
        lowest = min([part.first for part in self._manifest.current().of("registry")] + [0])
        self.write("registry", lowest - 1, rows)
        part = self._staged.pop(("registry", lowest - 1))
        self._manifest.publish(lambda old: old.with_parts(registry=[*old.of("registry"), part]))

    def live(self, replace_document: bool = False, index_name: str | None = None, doc_ids: Sequence[str] | None = None) -> DataFrame:
        """The index as it stands: the last snapshot and the batches after it.

        `index_name` and `doc_ids` narrow rows and deletions where they are read, before keys are compared.
        """
        return self._live(self._manifest.current(), replace_document, index_name, doc_ids)

    def _live(self, version: Version, replace_document: bool = False, index_name: str | None = None, doc_ids: Sequence[str] | None = None) -> DataFrame:
        columns = [f.name for f in INDEX_ROW.fields]
        wanted = {"index_name": index_name, "doc_id": None if doc_ids is None else list(doc_ids)}
        wanted = {name: value for name, value in wanted.items() if value is not None}
        parts = []
        if self._parts(version, "rows", version.compacted, version.committed):
            parts.append(stored(self._between(version, "rows", version.compacted, version.committed, **wanted)))
        if version.of("snapshot"):
            parts.append(filter_index(self._frame("snapshot", version.of("snapshot")), **wanted))
        if not parts:
            return self._frame("snapshot", []).select(*columns)
        # with the batch, as a message that was delivered again is told from the first by nothing else
        rows = reduce(DataFrame.unionByName, [with_place(part).select(*columns, "batch_id", "_file", "_at") for part in parts])
        if version.compacted == version.committed:
            # a snapshot that no batch came after has each row once, and none that a deletion took
            live = rows.select(*columns)
        else:
            live = live_stored_rows(rows, self._between(version, "deletes", None, version.committed, **wanted)).select(*columns)
        if replace_document:
            # the last write of a document is in the snapshot or after it, unless all of the document was deleted
            live = of_last_version(live, rows)
        return live

    def documents(self, index_name: str, doc_ids: Sequence[str], replace_document: bool = False) -> DataFrame:
        """Live rows of some documents of one index, the same as `live` gives of them, as one narrow query.

        Both conditions reach the scans, where the bounds and Bloom filters of row groups skip what has none of the
        documents. What is left are the versions of these few, so nothing is measured or settled on the way.
        """
        version = self._manifest.current()
        columns = [f.name for f in INDEX_ROW.fields]
        logged = stored(self._between(version, "rows", version.compacted, version.committed)).select(*columns, "batch_id")
        snapshot = self._frame("snapshot", version.of("snapshot")).select(*columns, "batch_id")
        wanted = {"index_name": index_name, "doc_id": list(doc_ids)}
        rows = filter_index(logged.unionByName(snapshot), **wanted)
        deletes = filter_index(self._between(version, "deletes", None, version.committed), **wanted)
        marks = deletes.select("index_name", "doc_id", F.col("arrival").alias("_deleted"))
        # a row's id holds its document's, so both windows need one shuffle
        by_document = Window.partitionBy("index_name", "doc_id")
        newest_first = Window.partitionBy("index_name", "doc_id", "row_id").orderBy(F.desc("arrival"), F.desc("batch_id"))
        found = rows.unionByName(marks, allowMissingColumns=True).select(
            *columns, F.max("_deleted").over(by_document).alias("_deleted"), F.max("arrival").over(by_document).alias("_last"), F.row_number().over(newest_first).alias("_n")
        )
        alive = F.col("row_id").isNotNull() & (F.col("_n") == 1) & (F.col("_deleted").isNull() | (F.col("arrival") > F.col("_deleted")))
        return found.where(alive & (F.col("arrival") == F.col("_last")) if replace_document else alive).select(*columns)

    def compact(self, files: int | None = None) -> None:
        """Write the live index as a snapshot, sorted by index and row, in place of the rows it was made of.

        The range split is on both columns: a hot index is cut over many files and small indices share one, and the
        file statistics let a filter on `index_name` skip the rest. A large one is written in `SLICES` ranges, one after the other,
        as the shuffle of all its texts and vectors takes twice the disk of the rows. Keys of all writes stay, for what is reported of deletions.
        """
        version = self._manifest.current()
        last = version.committed
        if last < 0 or last == version.compacted:
            return
        rows = self._live(version)
        keys = ["index_name", "row_id"]
        parts = []
        for part in _ranges(rows, SLICES, *keys):
            ranged = part.repartitionByRange(-(-files // SLICES), *keys) if files else part.repartitionByRange(*keys)
            self.write("snapshot", last, ranged.sortWithinPartitions(*keys))
            parts.append(self._staged.pop(("snapshot", last)))

        def change(old: Version) -> Version:
            if old.compacted >= last:
                return old
            return replace(old.with_parts(snapshot=parts, rows=[p for p in old.of("rows") if p.last > last]), compacted=last)

        self._manifest.publish(change)
        self._manifest.sweep([*version.folders(), *[part.folder for part in parts]])

    def fold(self) -> None:
        """Fold folders that are full in number into larger ones, and remove those that no kept version names any more.

        The last batch is left out, as a stream that restarts writes it again. A crash leaves the old folders in use.
        """
        version = self._manifest.current()
        folded: dict[str, tuple[set[Part], Part]] = {}
        for table in LOGGED:
            settled_parts = [part for part in version.of(table) if part.last < version.committed]
            for level in sorted({part.level for part in settled_parts}):
                parts = [part for part in settled_parts if part.level == level][:FOLD]
                if len(parts) == FOLD and table not in folded:
                    merged = self._write(table, self._frame(table, parts), parts[0].first, max(p.last for p in parts), level + 1)
                    folded[table] = (set(parts), merged)
        if not folded:
            return

        def change(old: Version) -> Version:
            # a table whose folders somebody else replaced meanwhile stays as it is
            fresh = {table: [p for p in old.of(table) if p not in parts] + [merged] for table, (parts, merged) in folded.items() if parts <= set(old.of(table))}
            return old.with_parts(**fresh)

        self._manifest.publish(change)
        self._manifest.sweep([*version.folders(), *[merged.folder for _, merged in folded.values()]])

    def index_text(self) -> None:
        """Write the postings of the last snapshot, which full-text search then reads instead of texts.

        As with a refresh of a search index, later batches are found after the next `compact` and `index_text`. The tables
        are named by the snapshot and become visible in one version, so a crash leaves the earlier ones in use.
        """
        version = self._manifest.current()
        base = version.compacted
        if base < 0 or base == version.indexed:
            return
        index = build_inverted(self._frame("snapshot", version.of("snapshot")))
        self.write("postings", base, index.blocks)
        self.write("sizes", base, index.sizes)
        made = {table: [self._staged.pop((table, base))] for table in ("postings", "sizes")}
        self._manifest.publish(lambda old: old if old.indexed >= base else replace(old.with_parts(**made), indexed=base))

    def inverted(self) -> Inverted | None:
        """The postings last written; None if there are none."""
        version = self._manifest.current()
        if version.indexed < 0:
            return None
        return Inverted(*[self._frame(table, version.of(table)).drop("batch_id") for table in ("postings", "sizes")])
