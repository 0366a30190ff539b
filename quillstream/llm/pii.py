"""Operator 2: personal data, also disguised, with places in the source text.

Plain identifiers are found in the text as it is: e-mail addresses, IPv4 addresses, card numbers and phone numbers, each
kind leftmost and non-overlapping; a match that fails its check (parts over 255, length, Luhn) is dropped.

For disguised ones the text goes through transducers, rules that rewrite parts of it and note where each piece came from:

    homoglyphs      look-alike letters, digits, full stops and at signs become ASCII; invisible characters vanish
    spelled digits  runs of number words (English, German, French, Spanish) and digits, four digits at least, become
                    digits; "dot" or "point" between them a full stop, "plus" before them a plus sign
    at and dot      "(at)", "[dot]" and their like become signs; bare words only in the shape of a whole address: with a bare
                    "dot" as well, or behind a name with a digit or a sign in it; a name of letters only has to be no word
                    that stands before "at" in prose (`_BEFORE_AT`), and its host to end as most mail hosts do

The same detectors run over the rewritten text, and each span is mapped back to the source characters it was made of. A
found span is added unless a plain one of its kind contains it; one that reaches beyond plain ones is added beside them,
numbers only if two number words at least lie beyond. Plain ones always stay. Most texts are rewritten by no rule
and are not scanned twice.

Places are code points, end exclusive. Cases: null text is empty; an empty text has no spans; texts of any length are read
whole, in time linear in their length; repeated rows are judged alike; an empty table gives an empty result; columns other
than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ints, rows_of, text_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# Detectors. The possessive forms match what the plain ones do, without trying a run of digits from each of its digits.

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)  # no local part reaches over an at sign
        at = text.find("@", max(done, at + 1))


def ips(text: str) -> Iterator[Span]:
    if text.count(".") < 3:
        return
    for run in _DOTTED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        parts, at = run.group().split("."), run.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            length = sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in four):
                yield at, at + length
            at += length + 1


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [v * 2 - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for run in _CARD.finditer(text):
        if run.end() - run.start() < 16:
            continue
        digits = run.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            yield run.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for run in _PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, run.group())) <= 15:
            yield run.span()


_DETECTORS = (emails, ips, cards, phones)
_HAS_DIGIT = re.compile(r"[0-9]")


def detect(text: str) -> list[list[Span]]:
    """Spans of each kind, ascending."""
    numeric = _HAS_DIGIT.search(text) is not None
    return [list(find(text)) if numeric or find is emails else [] for find in _DETECTORS]


# Transducers

# Code points of look-alikes, and the signs they stand for in the same order.
_LOOK_ALIKES = (
    ((0x430, 0x435, 0x43E, 0x440, 0x441, 0x443, 0x445, 0x456, 0x458, 0x455, 0x4BB, 0x501, 0x51B, 0x51D), "aeopcyxijshdqw"),  # Cyrillic
    ((0x410, 0x412, 0x415, 0x41A, 0x41C, 0x41D, 0x41E, 0x420, 0x421, 0x422, 0x423, 0x425, 0x406, 0x408, 0x405), "ABEKMHOPCTYXIJS"),
    ((0x3B1, 0x3B5, 0x3B9, 0x3BF, 0x3BD, 0x3C1, 0x3C4, 0x3C5, 0x3C7), "aeiovptux"),  # Greek
    ((0x391, 0x392, 0x395, 0x396, 0x397, 0x399, 0x39A, 0x39C, 0x39D, 0x39F, 0x3A1, 0x3A4, 0x3A5, 0x3A7), "ABEZHIKMNOPTYX"),
    ((0xFE6B, 0xFF20), "@@"),
    ((0x2024, 0x3002, 0xFF0E, 0xFF61, 0xFE52), "....."),
    ((0x2010, 0x2011, 0x2012, 0x2013, 0x2212, 0xFF0D), "------"),
    ((0xFF0B, 0xFE62), "++"),
    ((0xA0, 0x2002, 0x2003, 0x2009, 0x202F, 0x3000), " " * 6),
    ((0xFF08, 0xFF09), "()"),
)
_INVISIBLE = (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)
# First characters of ranges of ten digits, and of full-width and mathematical alphabets.
_DIGIT_RANGES = (0x660, 0x6F0, 0x966, 0xFF10, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)
_LETTER_RANGES = ((0xFF21, "A"), (0xFF41, "a"), (0x1D400, "A"), (0x1D41A, "a"), (0x1D5A0, "A"), (0x1D5BA, "a"), (0x1D670, "A"), (0x1D68A, "a"))


@lru_cache(maxsize=1)
def look_alikes() -> dict[str, str]:
    """ASCII sign of each look-alike; empty for an invisible character."""
    out = {chr(a): b for row, signs in _LOOK_ALIKES for a, b in zip(row, signs, strict=True)}
    out.update({chr(first + i): str(i) for first in _DIGIT_RANGES for i in range(10)})
    out.update({chr(first + i): chr(ord(sign) + i) for first, sign in _LETTER_RANGES for i in range(26)})
    out.update(dict.fromkeys(map(chr, _INVISIBLE), ""))
    return out


@lru_cache(maxsize=1)
def _look_alike_patterns() -> tuple[re.Pattern, re.Pattern]:
    """One that a text without look-alikes mostly fails at once, as letters of Latin script lie below them, and the exact one."""
    signs = sorted(look_alikes())
    low = "".join(sign for sign in signs if ord(sign) < 0x100)
    rough = f"[{low}{min(set(signs) - set(low))}-{chr(0x10FFFF)}]"
    return re.compile(rough), re.compile("[" + "".join(map(re.escape, signs)) + "]")


# Number words from zero on, by language.
_NUMBER_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_DIGIT_OF = {word: str(digit) for line in _NUMBER_WORDS for digit, word in enumerate(line.split())} | {"oh": "0"}
_DOT_WORDS = ("dot", "point", "punkt", "punto")
LEAST_DIGITS = 4
LEAST_BEYOND = 2  # number words outside the plain spans that a span overlaps
# Words of letters only that stand before "at" in prose, and ends of hosts that follow a name of letters only.
_BEFORE_AT = frozenset(
    "a all also and are arrive arrived at available be been but call check click contact do documentation email find found go had "
    "has have he her here him hosted i in is it join just learn listed live located look looked looking mail me meet more not now of "
    "on online only or order ours out page published read reached register registered see seen she shop sign site so start stay that "
    "the their them there they this to up us visit was we website were will with write you".split()
)
_MAIL_ENDS = frozenset("com org net edu gov info io de fr es uk example".split())



def _any_of(words: list[str]) -> str:
    """A pattern for any of the words that looks at each letter once."""
    ends, by_letter = "" in words, {}
    for word in filter(None, sorted(words)):
        by_letter.setdefault(word[0], []).append(word[1:])
    inner = "|".join(re.escape(letter) + _any_of(rest) for letter, rest in by_letter.items())
    return "" if not inner else f"(?:{inner})" + "?" * ends


_NUMBER = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
_DOTS = "|".join(_DOT_WORDS)
_JOIN = rf"(?:[\s.,()-]{{1,3}}(?:(?:{_DOTS})[\s-]{{1,3}})?)"
_SPELLED = re.compile(rf"(?i)(?<!\w)(?:plus[\s-]{{1,3}})?+(?:(?:{_NUMBER}|[0-9]++)(?:{_JOIN}(?:{_NUMBER}|[0-9]++)(?!\w))++)(?!\w)")
_SPELLED_PART = re.compile(rf"(?i)plus|{_NUMBER}|[0-9]+|{_DOTS}|\.|[\s,()-]+")
_NUMBER_WORD = re.compile(rf"(?i)(?<!\w)(?:{_NUMBER})(?!\w)")
# Two neighbours of a run of which one is a number word, in lower-cased text.
_WORD = _any_of(list(_DIGIT_OF))
_MAYBE_SPELLED = re.compile(rf"[^\w](?:{_WORD}{_JOIN}(?:{_WORD}|[0-9])|[0-9]++{_JOIN}{_WORD})")
# Letters that stand for digits, with digits on both sides.
_LETTER_DIGITS = re.compile(r"(?<=[0-9])[OolI]{1,4}(?=[0-9])")
_LETTER_DIGIT = {"O": "0", "o": "0", "l": "1", "I": "1"}

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT_MARK = rf"\s{{0,3}}{_OPEN}\s{{0,3}}(?:at|@|arroba)\s{{0,3}}{_CLOSE}\s{{0,3}}"
_DOT_MARK = rf"\s{{0,3}}{_OPEN}\s{{0,3}}(?:{_DOTS}|\.)\s{{0,3}}{_CLOSE}\s{{0,3}}"
_MARKED = re.compile(rf"(?i)(?:(?P<at>{_AT_MARK})|(?P<dot>{_DOT_MARK}))(?=[A-Za-z0-9])")
_LABEL = r"[A-Za-z0-9-]{1,63}+"
_BARE_DOT = rf"\s{{1,3}}(?:{_DOTS})\s{{1,3}}"
# name AT host DOT com, where a bare word stands for a sign at least once
_BARE = re.compile(
    rf"(?i)(?:(?<=[A-Za-z0-9._%+-])\s{{1,3}}(?:at|arroba)\s{{1,3}}|@){_LABEL}(?:(?:{_BARE_DOT}|\.){_LABEL})*?{_BARE_DOT}[A-Za-z]{{2,24}}\b"
)
# name AT host.com; the name has to look like one, see `_looks_like_name`
_BARE_AT = re.compile(rf"(?i)(?<=[A-Za-z0-9_%+-])\s{{1,3}}(?:at|arroba)\s{{1,3}}(?=(?P<host>(?:{_LABEL}\.)+[A-Za-z]{{2,24}}\b))")
_BARE_SIGN = re.compile(rf"(?i)(?P<at>\s{{1,3}}(?:at|arroba)\s{{1,3}})|(?P<dot>{_BARE_DOT})")
_MAYBE_BARE = re.compile(rf"(?i)\s(?:{_DOTS})\s")
_MAYBE_MARKED = re.compile(rf"(?i){_OPEN}\s{{0,3}}(?:at|@|arroba|{_DOTS}|\.)\s{{0,3}}{_CLOSE}")

Edit = tuple[int, int, str]


class Rewritten(NamedTuple):
    """A text and where its pieces came from: piece i starts at `at[i]` and was made of source[first[i]:last[i]]; a piece
    that was not rewritten has a length of its own and maps place by place."""

    text: str
    at: list[int]
    first: list[int]
    last: list[int]
    kept: list[bool]

    def source(self, start: int, stop: int) -> Span:
        """Source characters of a span."""
        a, b = bisect_right(self.at, start) - 1, bisect_right(self.at, stop - 1) - 1
        begin = self.first[a] + (start - self.at[a] if self.kept[a] else 0)
        end = self.first[b] + (stop - self.at[b]) if self.kept[b] else self.last[b]
        return begin, end


def unchanged(text: str) -> Rewritten:
    return Rewritten(text, [0], [0], [len(text)], [True])


def rewrite(before: Rewritten, edits: list[Edit]) -> Rewritten:
    """Apply ascending edits (start, stop, new) to a text that may be rewritten already; places stay those of the source."""
    pieces: list[tuple[str, int, int, bool]] = []

    def keep(start: int, stop: int) -> None:
        piece = bisect_right(before.at, start) - 1
        while start < stop:
            end = min(stop, before.at[piece + 1] if piece + 1 < len(before.at) else len(before.text))
            if end > start:
                text = before.text[start:end]
                if before.kept[piece]:
                    origin = before.first[piece] + start - before.at[piece]
                    pieces.append((text, origin, origin + len(text), True))
                else:
                    pieces.append((text, before.first[piece], before.last[piece], False))
                start = end
            piece += 1

    done = 0
    for start, stop, new in edits:
        keep(done, start)
        if new:
            pieces.append((new, *before.source(start, stop), False))
        done = stop
    keep(done, len(before.text))
    at, length = [], 0
    for piece in pieces:
        at.append(length)
        length += len(piece[0])
    return Rewritten("".join(p[0] for p in pieces), at or [0], [p[1] for p in pieces] or [0], [p[2] for p in pieces] or [0], [p[3] for p in pieces] or [True])


def homoglyph_edits(text: str) -> list[Edit]:
    if text.isascii():
        return []
    rough, exact = _look_alike_patterns()
    if not rough.search(text):
        return []
    signs = look_alikes()
    return [(m.start(), m.end(), signs[m.group()]) for m in exact.finditer(text)]


def spelled_digit_edits(text: str) -> list[Edit]:
    edits: list[Edit] = []
    for run in _SPELLED.finditer(text) if _MAYBE_SPELLED.search(f" {text.lower()}") else ():
        parts = [(run.start() + m.start(), run.start() + m.end(), m.group().lower()) for m in _SPELLED_PART.finditer(run.group())]
        digits = sum(len(part) if part[0].isdigit() else part in _DIGIT_OF for _, _, part in parts)
        if digits < LEAST_DIGITS or not any(part in _DIGIT_OF for _, _, part in parts):
            continue
        for start, stop, part in parts:
            if not part.isdigit():
                sign = _DIGIT_OF.get(part) or ("+" if part == "plus" else "." if part in _DOT_WORDS or part == "." else "")
                edits.append((start, stop, sign))
    spelled = [edit[:2] for edit in edits]
    for run in _LETTER_DIGITS.finditer(text) if _HAS_DIGIT.search(text) else ():
        edits += [(at, at + 1, _LETTER_DIGIT[text[at]]) for at in range(*run.span())]
    return sorted(edits) if spelled else edits


def sign_edits(text: str) -> list[Edit]:
    edits: list[Edit] = []
    if _MAYBE_MARKED.search(text):
        edits += [(m.start(), m.end(), "@" if m.group("at") else ".") for m in _MARKED.finditer(text) if m.start() and text[m.start() - 1].isalnum()]
    return edits


def _looks_like_name(text: str, stop: int, host_stop: int) -> bool:
    """Whether the local part that ends at `stop` is one: it holds a digit or a sign, or is no usual word before "at"."""
    start = stop
    while start > 0 and stop - start < 64 and text[start - 1] in _LOCAL:
        start -= 1
    name = text[start:stop].strip(".-")
    if not name.isalpha():
        return True
    end = text[stop:host_stop].rpartition(".")[2].lower()
    return name == text[start:stop] and name.lower() not in _BEFORE_AT and end in _MAIL_ENDS


def bare_sign_edits(text: str) -> list[Edit]:
    edits: list[Edit] = [(m.start(), m.end(), "@") for m in _BARE_AT.finditer(text) if _looks_like_name(text, m.start(), m.end("host"))]
    if _MAYBE_BARE.search(text):
        for m in _BARE.finditer(text):
            edits += [(m.start() + s.start(), m.start() + s.end(), "@" if s.group("at") else ".") for s in _BARE_SIGN.finditer(m.group())]
    return sorted(set(edits))


def normalise(text: str) -> Rewritten | None:
    """The text after all transducers; None if none of them changed it."""
    out = None
    for transducer in (homoglyph_edits, sign_edits, bare_sign_edits, spelled_digit_edits):
        edits = transducer(out.text if out else text)
        if edits:
            out = rewrite(out or unchanged(text), edits)
    return out


def _beyond(text: str, start: int, stop: int, met: list[Span], kind: str) -> bool:
    """Whether a span tells more than the plain ones it meets."""
    outer, at = [], start
    for begin, end in met:
        outer.append(text[at : max(at, begin)])
        at = max(at, end)
    outer.append(text[at : max(at, stop)])
    if kind == "email":
        return any(outer)
    return sum(len(_NUMBER_WORD.findall(part)) for part in outer) >= LEAST_BEYOND


def disguised(text: str, plain: list[list[Span]]) -> list[list[Span]]:
    """Spans that only the rewritten text shows, by kind, mapped back to `text`."""
    rewritten = normalise(text)
    if rewritten is None:
        return [[] for _ in KINDS]
    added = []
    for kind, spans, known in zip(KINDS, detect(rewritten.text), plain):
        starts = [start for start, _ in known]
        own = []
        for start, stop in (rewritten.source(*span) for span in spans):
            # plain spans of a kind do not overlap, so those that meet this one are neighbours
            first = max(0, bisect_right(starts, start) - 1)
            met = [span for span in known[first : bisect_right(starts, stop - 1)] if span[1] > start]
            if not met or _beyond(text, start, stop, met, kind):
                own.append((start, stop))
        added.append(own)
    return added


def written(spans: list[list[Span]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for kind, own in zip(KINDS, spans) for start, stop in own)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of plain spans by kind, base_sha256 of the plain spans, `spans` (disguised ones too), and n_disguised."""
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_disguised"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, lists, extra = [], [], []
            for value in batch.column(1):
                text = value.as_py()
                plain = detect(text)
                added = disguised(text, plain)
                for column, spans in zip(counts, plain):
                    column.append(len(spans))
                digests.append(hashlib.sha256(written(plain).encode()).hexdigest())
                lists.append(written([sorted(a + b) for a, b in zip(plain, added)]))
                extra.append(sum(map(len, added)))
            arrays = [batch.column(0), *map(ints, counts), pa.array(digests, pa.string()), pa.array(lists, pa.string()), ints(extra)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id bigint, " + ", ".join(f"n_{kind} bigint" for kind in KINDS) + ", base_sha256 string, spans string, n_disguised bigint"
    return text_of(docs).mapInArrow(run, schema)
