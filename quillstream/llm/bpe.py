"""Operator 6: byte-pair encoding and decoding by batched merge rounds in numpy.

A text is cut at white space; the pieces do not influence each other, so a task encodes each distinct piece once and
keeps it in a cache of bounded size. The words of all new pieces of a batch lie in one flat array of symbols. Every round
finds each word's pair of the lowest rank, by binary search of pair keys in the sorted keys of the merge table, and
merges it; only pairs beside a merge are looked up again. Results are those of the `tokenizers` library for the same
file, with special tokens in a text taken as such, no added ones, no truncation and no padding.

Cases: null text is empty; an empty text has no ids and decodes to the empty string; a text of any length is read whole
(a round over one long word is linear in it); repeated rows are encoded like any others; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from .common import ints, rows_of, text_of

CACHE_PIECES = 150_000  # per generation and task; two generations are kept

# What the file's white space means beyond Python's str.split, which also cuts at U+001C to U+001F.
_CONTROL_SEPARATORS = regex.compile("[" + "".join(map(chr, range(0x1C, 0x20))) + "]")
_SPACES = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_SPACE = regex.compile("[" + "".join(map(chr, _SPACES)) + "]+")
_NONE = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself, or the next free one from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(byte if byte in printable else next(free)) for byte in range(256)]


def split_spaces(text: str) -> list[str]:
    """Pieces between white space as the tokenizer file means it."""
    if _CONTROL_SEPARATORS.search(text):
        return [piece for piece in _SPACE.split(text) if piece]
    return text.split()


class Merges:
    """The merge table of a byte-level BPE file with word ends, as sorted pair keys."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        pairs = [pair if isinstance(pair, list) else pair.split(" ", 1) for pair in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = left * self.size + right
        # a pair given twice has the rank of its last line
        keys, last = np.unique(keys[::-1], return_index=True)
        self.keys, self.ranks = keys, len(pairs) - 1 - last.astype(np.int64)
        # A merge whose product takes part in an earlier merge is done one place at a time, as its product goes first then.
        first_use = np.full(self.size, _NONE, dtype=np.int64)
        np.minimum.at(first_use, left, np.arange(len(pairs)))
        np.minimum.at(first_use, right, np.arange(len(pairs)))
        self.one_by_one = first_use[self.made] <= np.arange(len(pairs))
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.final = np.array([vocab[s + self.end] for s in symbols], dtype=np.int64)
        self.tokens = {number: token for token, number in vocab.items()}
        self.tokens.update({number: token for token, number in self.special.items()})
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self._library = (
            Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None})).normalizer,
            Split(Regex(split["pattern"]["Regex"]), "removed", invert=True),
        )
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each non-empty word."""
        done: list[np.ndarray] = [np.empty(0, dtype=np.int64)] * len(words)
        if not words:
            return done
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        last = np.cumsum(lengths) - 1
        flat = self.inner[data]
        flat[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        # rank[i] is that of the pair (i, i + 1); the last symbol of a word has none
        rank = np.full(len(flat), _NONE, dtype=np.int64)
        rank[:-1] = self._rank(flat[:-1], flat[1:])
        rank[last] = _NONE
        while len(flat):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(flat)])
            finished = lowest == _NONE
            if finished.any():
                for start, size in zip(starts[finished].tolist(), sizes[finished].tolist()):
                    done[word[start]] = flat[start : start + size]
                going = np.repeat(~finished, sizes)
                flat, word, rank = flat[going], word[going], rank[going]
                lowest, sizes = lowest[~finished], sizes[~finished]
                if not len(flat):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, sizes))
            fresh = np.r_[True, word[at[1:]] != word[at[:-1]]]
            at = at[fresh | ~self.one_by_one[rank[at]]]
            # of overlapping places, as in "aaa", each second one is left
            runs = np.r_[True, np.diff(at) != 1]
            run_start = np.maximum.accumulate(np.where(runs, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            flat[at] = self.made[rank[at]]
            keep = np.ones(len(flat), dtype=bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]
            flat, word, rank = flat[keep], word[keep], rank[keep]
            at = at - np.arange(len(at))  # each merge before a place moved it by one
            touched = np.concatenate([at, at[at > 0] - 1])
            touched = touched[touched < len(flat) - 1]
            inside = word[touched] == word[touched + 1]
            touched = touched[inside]
            rank[touched] = self._rank(flat[touched], flat[touched + 1])
            ends = at[(at == len(flat) - 1)]
            rank[ends] = _NONE
            at = at[at < len(flat) - 1]
            rank[at[word[at] != word[at + 1]]] = _NONE
        return done

    def words_of(self, piece: str) -> list[str]:
        """Words of a piece without white space, after normalisation."""
        if piece.isascii():
            if piece.isalpha():
                return [piece.lower()]
            if piece[:-1].isalpha() and piece[-1] in ".,":  # the commonest other shapes, without a regex
                return [piece[:-1].lower(), piece[-1]]
        if not piece.isascii():
            if not piece.isprintable() and any(unicodedata.category(char) == "Cn" for char in piece):
                # Python and the library may be of different Unicode versions about these characters
                return [word for word, _ in self._library[1].pre_tokenize_str(self._library[0].normalize_str(piece))]
            # lower case by character, without Python's rule for a sigma at a word's end
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ")
        return self.word.findall(piece.lower())

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, np.ndarray]:
        """Ids of each piece; words that several pieces share are encoded once."""
        cut = {piece: self.special_words(piece) for piece in pieces}
        unique = list({word for words in cut.values() for word in words if isinstance(word, str)})
        ids = dict(zip(unique, self.encode_words([word.encode() for word in unique])))
        out = {}
        for piece, words in cut.items():
            parts = [ids[word] if isinstance(word, str) else np.array([word], dtype=np.int64) for word in words]
            out[piece] = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        return out

    def special_words(self, piece: str) -> list[str | int]:
        if self.special_pattern is None or "<" not in piece:
            return self.words_of(piece)
        words: list[str | int] = []
        for part in self.special_pattern.split(piece):
            words.extend([self.special[part]] if part in self.special else self.words_of(part))
        return words


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    """Loaded once by each Python worker."""
    return Merges(path)


class _Young(dict):
    """A dictionary that notes what it was asked for in vain, each time."""

    def __init__(self) -> None:
        super().__init__()
        self.missing: list[str] = []

    def __missing__(self, piece: str) -> None:
        self.missing.append(piece)


class PieceCache:
    """What was made of each piece, in two generations: when the young one is full, the old one goes."""

    def __init__(self, make: Callable[[set[str]], dict[str, Any]], limit: int = CACHE_PIECES) -> None:
        self.make, self.limit = make, limit
        self.young, self.old = _Young(), {}

    def peek(self, piece: str) -> Any:
        """What was made of a piece, None if it is not at hand."""
        found = self.young.get(piece)
        return self.old.get(piece) if found is None else found

    def of(self, lists: list[list[str]]) -> list[list[Any]]:
        """What was made of each piece of several lists; new pieces of all lists are made together."""
        young, found, gaps = self.young, [], []
        for i, pieces in enumerate(lists):
            known = len(young.missing)
            found.append(list(map(young.__getitem__, pieces)))
            if len(young.missing) > known:
                gaps.append(i)
        missing, young.missing = set(young.missing), []
        if missing:
            old = self.old
            again = {piece: old[piece] for piece in missing if piece in old}
            if len(young) + len(missing) > self.limit and young:
                self.old, self.young = young, _Young()
                young = self.young
            if len(again) < len(missing):
                young.update(self.make(missing.difference(again)))
            young.update(again)
            # most are at hand, and a second look into a large dictionary is dear
            for i in gaps:
                found[i] = [young[piece] if entry is None else entry for piece, entry in zip(lists[i], found[i])]
        return found


def _entries(table: Merges) -> Callable[[set[str]], dict[str, tuple[str, str]]]:
    """Decimals and tokens of pieces; any piece has at least one token, as the words cover all that is not white space."""
    names = table.tokens

    def make(pieces: set[str]) -> dict[str, tuple[str, str]]:
        out = {}
        for piece, ids in table.encode_pieces(pieces).items():
            listed = ids.tolist()
            out[piece] = (" ".join(map(str, listed)), " ".join([names[i] for i in listed]))
        return out

    return make


@lru_cache(maxsize=2)
def _worker_cache(path: str) -> PieceCache:
    """One for each Python worker, which goes on to later tasks."""
    return PieceCache(_entries(merges(path)))


def encode_texts(texts: list[str], cache: PieceCache) -> Iterator[tuple[int, str, str]]:
    """Per text: number of ids, ids as decimals, and the decoded text (tokens with a space between: the file has no decoder)."""
    pieces = [split_spaces(text.lower() if text.isascii() and "<" not in text else text) for text in texts]
    for found in cache.of(pieces):
        ids = " ".join([entry[0] for entry in found])
        yield ids.count(" ") + 1 if found else 0, ids, " ".join([entry[1] for entry in found])


def encode(docs: DataFrame, path: str, texts: bool = True, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens and, as asked, `ids` (decimals) with `decoded`, or the SHA-256 of both; one Arrow pass without a shuffle."""
    schema = "doc_id bigint, n_tokens bigint"
    schema += ", ids string, decoded string" if texts else ""
    schema += ", ids_sha256 string, decoded_sha256 string" if digests else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _worker_cache(path)
        for batch in rows_of(batches):
            found = list(encode_texts(batch.column(1).to_pylist(), cache))
            columns = [batch.column(0), ints([n for n, _, _ in found])]
            if texts:
                columns += [pa.array([ids for _, ids, _ in found], pa.string()), pa.array([t for _, _, t in found], pa.string())]
            if digests:
                for place in (1, 2):
                    digest = [hashlib.sha256(entry[place].encode()).hexdigest() for entry in found]
                    columns.append(pa.array(digest, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[part.split()[0] for part in schema.split(", ")])

    return text_of(docs).mapInArrow(run, schema)


def decode(ids: str, path: str) -> str:
    """Text of ids given as decimals."""
    names = merges(path).tokens
    return " ".join(names[int(i)] for i in ids.split())
