"""Operator 10: token ids of documents in files of independent zstandard frames with a trailing seek table.

A file holds the ids of consecutive documents as one stream of little-endian integers (16 bits where the vocabulary allows
it, else 32), cut into frames of `FRAME_IDS` ids whatever the documents' borders:

    zstandard frames      each with its own content checksum
    skippable frame       magic 0x184D2A50: id width, number of documents, then per document id, null mark, first id
    skippable frame       magic 0x184D2A5E: the seek table of zstandard's seekable format, with a checksum per frame

so any zstandard reader unpacks the stream, and `lookup` fetches the tail and then only the frames of the documents asked for.

Texts are encoded where they lie, and only their ids are dealt out by ranges of doc_id and sorted, so files are ascending and
disjoint; each task streams its range into one file. A file's name is new for each attempt, and only files named in the settled manifest count: an executor
lost half-way leaves at most an unnamed file behind. Files go to the folder in spark.checkpoint.dir or another shared one.

Texts are encoded with the `tokenizers` library: its model gives the ids of each distinct word, see `bpe` for the cutting.

Cases: null text is empty and has the end id only; null doc_id comes first; rows of one doc_id are ordered by their ids' bytes; an
empty table gives no file; a text of any length may span frames; other columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from quillstream.plans.sizing import source_bytes
from quillstream.session import checkpoint_folder, settle

from .bpe import PieceCache, byte_symbols, merges
from .common import ints, rows_of, text_of

END_ID = 1
FRAME_IDS = 1 << 16
FILE_BYTES = 64 << 20  # of source for each file, at least as many files as shuffle partitions
CACHE_PIECES = 400_000
SLICE_BYTES = 8 << 20  # of text whose pieces are looked up together
# White space beyond ASCII as the tokenizer file means it.
_WIDE_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Fixed values of the zstandard seekable format.
INDEX_MAGIC, SEEK_MAGIC, SEEK_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80

MANIFEST = "part bigint, path string, n_docs bigint, n_ids bigint, n_bytes bigint, min_id bigint, max_id bigint, has_null boolean"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class TokenWriter:
    """Streams documents into one file."""

    def __init__(self, sink, width: int) -> None:
        self.sink, self.width = sink, width
        self.pack = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.n_ids = self.n_bytes = 0
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids) // self.width
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * FRAME_IDS * self.width:
            self._flush(FRAME_IDS * self.width)

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.n_bytes += len(data)

    def _flush(self, least: int) -> None:
        data, size = b"".join(self.waiting), FRAME_IDS * self.width
        at = 0
        while len(data) - at >= least and at < len(data):
            raw = data[at : at + size]
            packed = self.pack.compress(raw)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self._write(packed)
            at += len(raw)
        self.waiting = [data[at:]]
        self.waiting_bytes = len(data) - at

    def close(self) -> None:
        self._flush(1)
        known = [0 if i is None else i for i in self.doc_ids]
        body = struct.pack("<IQ", self.width, len(known)) + np.array(known, "<i8").tobytes()
        body += np.array([i is None for i in self.doc_ids], "u1").tobytes() + np.array(self.starts, "<u8").tobytes()
        index = struct.pack("<II", INDEX_MAGIC, len(body)) + body
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_FOOTER)
        self._write(index)
        self._write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.sink.close()


class TokenReader:
    """Random access to one file; reads its tail first and then the frames asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        n_frames, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_FOOTER or flags != CHECKSUM_FLAG:
            raise ValueError("no seek table")
        table_at = size - 9 - 12 * n_frames - 8
        entries = np.frombuffer(self._read(table_at + 8, 12 * n_frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.raw, self.sums = entries.T
        self.at = np.concatenate([[0], np.cumsum(self.packed)])
        index_at = int(self.at[-1])
        head = struct.unpack("<IIIQ", self._read(index_at, 20))
        if head[0] != INDEX_MAGIC:
            raise ValueError("no document index")
        self.width, n = head[2], head[3]
        body = self._read(index_at + 20, 17 * n)
        self.ids = np.frombuffer(body, "<i8", n)
        self.null = np.frombuffer(body, "u1", n, 8 * n).astype(bool)
        self.starts = np.frombuffer(body, "<u8", n, 9 * n).astype(np.int64)
        self.n_ids = int(self.raw.sum()) // self.width
        self.ends = np.append(self.starts[1:], self.n_ids) if n else self.starts
        self.unpack = zstandard.ZstdDecompressor()
        self.held: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint32))
        self.frames_read = 0

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def frame(self, number: int) -> np.ndarray:
        """Ids of a frame; its checksum is verified."""
        if self.held[0] != number:
            raw = self.unpack.decompress(self._read(int(self.at[number]), int(self.packed[number])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[number]:
                raise ValueError(f"frame {number} is damaged")
            self.held = (number, np.frombuffer(raw, f"<u{self.width}").astype("<u4"))
            self.frames_read += 1
        return self.held[1]

    def pieces(self, place: int) -> Iterator[np.ndarray]:
        """Ids of the document at `place`, frame by frame."""
        at, end = int(self.starts[place]), int(self.ends[place])
        while at < end:
            number, offset = divmod(at, FRAME_IDS)
            piece = self.frame(number)[offset : offset + end - at]
            yield piece
            at += len(piece)

    def places(self, doc_ids: list[int | None]) -> list[int]:
        """Places of the documents asked for; ids ascend, those without one come first."""
        nulls = int(self.null.sum())
        found = list(range(nulls)) if None in doc_ids else []
        known = np.array(sorted({i for i in doc_ids if i is not None}), dtype=np.int64)
        first, last = (nulls + np.searchsorted(self.ids[nulls:], known, side) for side in ("left", "right"))
        return found + [place for a, b in zip(first.tolist(), last.tolist()) for place in range(a, b)]


class _WordIds:
    """Ids of words by the library's model, as bytes of the file's width."""

    def __init__(self, path: str, width: int) -> None:
        self.table, self.tokenize = merges(path), Tokenizer.from_file(path).model.tokenize
        self.symbol = byte_symbols()
        largest = max(self.table.size, max(self.table.special.values(), default=0) + 1)
        self.coded = [i.to_bytes(width, "little") for i in range(largest)]

    def of_word(self, word: str) -> bytes:
        coded = self.coded
        plain = word.isascii() and word.isprintable()  # then its characters stand for themselves
        tokens = self.tokenize(word if plain else "".join([self.symbol[byte] for byte in word.encode()]))
        return coded[tokens[0].id] if len(tokens) == 1 else b"".join([coded[token.id] for token in tokens])

    def of_pieces(self, pieces: set[str], peek: Callable[[str], bytes | None]) -> dict[str, bytes]:
        """`peek` gives what is known already: a word alone is a piece of its own."""
        words: dict[str | int, bytes] = {}
        out = {}
        of_word, special_words = self.of_word, self.table.special_words
        for piece in pieces:
            if piece.isalpha() and piece.isascii():  # one word, and known to be new
                word = piece.lower()
                out[piece] = words[word] = words.get(word) or of_word(word)
                continue
            own = special_words(piece)
            for word in own:
                if word not in words:
                    words[word] = self.coded[word] if isinstance(word, int) else peek(word) or of_word(word)
            out[piece] = words[own[0]] if len(own) == 1 else b"".join([words[word] for word in own])
        return out


@lru_cache(maxsize=1)
def _worker_cache(path: str, width: int) -> PieceCache:
    """One for each Python worker, which goes on to later tasks."""
    ids = _WordIds(path, width)
    cache = PieceCache(lambda pieces: ids.of_pieces(pieces, cache.peek), CACHE_PIECES)
    return cache


def _pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts between white space and the number of each text's; some may be empty."""
    ascii = pc.string_is_ascii(texts)
    if not pc.all(ascii).as_py():
        texts = pc.replace_substring_regex(texts, _WIDE_SPACE, " ")
    plain = pc.and_(ascii, pc.invert(pc.match_substring(texts, "<")))
    lists = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(texts), texts))
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _ids_of(texts: pa.Array, cache: PieceCache, width: int) -> pa.Array:
    """Ids of each text with the end id, as bytes: each different piece is looked up once, and its ids are gathered for all places."""
    pieces, counts = _pieces_of(texts)
    coded = pieces.dictionary_encode()
    # one string that is split again: faster than a string each, and no piece has a line's end
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), "\n")
    entries = cache.of([joined[0].as_py().split("\n")])[0]
    kind = f"<u{width}"
    flat = np.concatenate([np.frombuffer(b"".join(entries), kind), np.array([END_ID], kind)])
    sizes = np.fromiter(map(len, entries), np.int64, len(entries)) // width
    sizes, first = np.append(sizes, 1), np.append(np.cumsum(sizes) - sizes, len(flat) - 1)
    ends = np.cumsum(counts)
    places = np.insert(coded.indices.to_numpy(zero_copy_only=False), ends, len(entries))
    n_ids = sizes[places]
    done = np.cumsum(n_ids)
    ids = flat[np.repeat(first[places] - (done - n_ids), n_ids) + np.arange(done[-1])]
    offsets = np.append(0, done[ends + np.arange(len(ends))] * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])


def write_token_files(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Write the files and return their settled manifest, in ascending order of `part`."""
    spark = docs.sparkSession
    root = f"{(folder or checkpoint_folder(spark)).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    size, parts = source_bytes(docs), int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size < 1 << 60:  # else the source has no statistics
        parts = max(parts, size // FILE_BYTES)
    width = 2 if merges(path).size + len(merges(path).special) <= 1 << 16 else 4

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _worker_cache(path, width)
        for batch in rows_of(batches, SLICE_BYTES):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), _ids_of(batch.column(1), cache, width)], names=["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, name = None, f"{root}/{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}.tokens"
        for batch in batches:
            if writer is None and batch.num_rows:
                store, local = open_fs(name)
                store.create_dir(local.rsplit("/", 1)[0], recursive=True)
                writer = TokenWriter(store.open_output_stream(local), width)
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                writer.add(doc_id, ids.as_py())
        if writer is None:
            return
        writer.close()
        ids = [i for i in writer.doc_ids if i is not None]
        row = (TaskContext.get().partitionId(), name, len(writer.doc_ids), writer.n_ids, writer.n_bytes)
        row += (min(ids, default=None), max(ids, default=None), len(ids) < len(writer.doc_ids))
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5, pa.bool_()]
        names = [field.split()[0] for field in MANIFEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names=names)

    # settled, as the ranges are drawn from it before it is dealt out
    ids = settle(text_of(docs).mapInArrow(encoded, "doc_id bigint, ids binary"))
    order = F.col("doc_id").asc_nulls_first()
    ordered = ids.repartitionByRange(parts, order).sortWithinPartitions(order, "ids")
    return settle(ordered.mapInArrow(run, MANIFEST))


def _crc(pieces: Iterator[np.ndarray]) -> int:
    value = 0
    for piece in pieces:
        value = zlib.crc32(piece.tobytes(), value)
    return value


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, and the CRC-32 of its ids."""
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = settle(manifest.select("part", "path", F.coalesce(before, F.lit(0)).alias("base")))
    spark = manifest.sparkSession
    n = max(1, min(files.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                store, local = open_fs(path)
                with store.open_input_file(local) as source:
                    reader = TokenReader(source)
                    for start in range(0, len(reader.ids), 10_000):
                        places = range(start, min(start + 10_000, len(reader.ids)))
                        sums = [_crc(reader.pieces(place)) for place in places]
                        span = slice(places.start, places.stop)
                        ids = pa.array(reader.ids[span], pa.int64(), mask=reader.null[span])
                        counts = reader.ends[span] - reader.starts[span]
                        columns = [ids, ints(reader.starts[span] + base), ints(counts), ints(sums)]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartitionByRange(n, "part").mapInArrow(run, DOCUMENTS)


def lookup(manifest: DataFrame, doc_ids: list[int]) -> DataFrame:
    """Ids of the documents asked for, by reading their frames only: doc_id, ids, and the number of frames a file gave so far."""
    asked = F.array(*[F.lit(i).cast("bigint") for i in doc_ids]) if doc_ids else F.lit(None).cast("array<bigint>")
    holding = manifest.filter(F.exists(asked, lambda i: i.between(F.col("min_id"), F.col("max_id")))).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, local = open_fs(path)
                with store.open_input_file(local) as source:
                    reader = TokenReader(source)
                    for place in reader.places(doc_ids):
                        ids = np.concatenate(list(reader.pieces(place)))
                        columns = [ints([reader.ids[place]]), pa.array([ids.astype(np.int64)], pa.list_(pa.int64())), ints([reader.frames_read])]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "frames_read"])

    return holding.mapInArrow(run, "doc_id bigint, ids array<bigint>, frames_read bigint")
