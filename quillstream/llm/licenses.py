"""Operator 4: licence scans by a positional index of rare words, in DataFrame functions only.

The index holds, for each licence template, the places of the rarest words of its mandatory key phrase: those of the highest
inverse document frequency, counted over all texts. In a file each occurrence of such a word is looked up, and each of its
places in a template proposes an alignment of file and template. The postings of a template are intersected by relative
position: an alignment on which all of them agree is a candidate. It is a find if the key phrase stands there word by word
and the template's words that stand at their places are a share of `LEAST_SCORE` at least, which is its score. A find holds its
whole key phrase and so all postings of its template; the look-up loses none, whatever words are rare and whatever the
other texts hold.

The short phrases of `BASE` are templates that are mandatory as a whole.

Words are runs of ASCII letters and digits, A-Z lower-cased, and all characters beyond ASCII; places count words from 0.

Cases: null text is empty; a text without words has no finds, null places and score 0; a template may begin before the
text or end behind it as long as its key phrase lies inside; repeated rows are judged alike; an empty table gives an empty
result; columns other than doc_id and text are not read. One text's words are held by one task at a time.
"""

from __future__ import annotations

from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of


class Template(NamedTuple):
    label: str
    words: list[str]
    phrase: tuple[int, int]  # place and length of the mandatory phrase
    base: bool

    @property
    def key(self) -> list[str]:
        at, size = self.phrase
        return self.words[at : at + size]


def _template(label: str, text: str, phrase: str = "") -> Template:
    words, key = text.split(), (phrase or text).split()
    at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    return Template(label, words, (at, len(key)), not phrase)


# Phrases of the base labels, then licence notices in words, each with its key phrase.
BASE = (
    _template("cc-by", "cc by"),
    _template("gpl", "general public license"),
    _template("reserved", "all rights reserved"),
)
NOTICES = (
    _template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    _template("mit", "released under the mit license", "mit license"),
    _template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    _template("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    _template("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    _template("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    _template("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    _template("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    _template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    _template("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    _template("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    _template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    _template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    _template("isc", "permission to use copy modify and or distribute this software for any purpose", "use copy modify and or distribute"),
    _template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
        "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
        "use copy modify merge publish distribute sublicense",
    ),
    _template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind "
        "either express or implied see the license for the specific language governing permissions and limitations under the license",
        "unless required by applicable law or agreed to in writing software distributed under the license",
    ),
    *[
        _template(
            f"gpl-{number}.0",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            f"published by the free software foundation either version {number} of the license or at your option any later version this "
            "program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of "
            "merchantability or fitness for a particular purpose see the gnu general public license for more details",
            f"either version {number} of the license",
        )
        for number in (2, 3)
    ],
    _template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution",
        "redistributions in binary form must reproduce the above copyright notice",
    ),
    _template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
TEMPLATES = BASE + NOTICES

RARE_WORDS = 2  # of a key phrase that are looked up; any number gives the same finds
LEAST_SCORE = 0.5  # share of a notice's words at their places
_SHIFT, _BEFORE = 40, 1000  # an alignment in one number: template, and place moved so that none is negative

DELIMITERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN, _ANGSTROM = chr(0x212A), chr(0x212B)


def words_of(text: Column) -> Column:
    """Words of a text. Of all characters beyond ASCII only the Kelvin sign becomes an ASCII letter by `lower`: it is put aside."""
    lowered = F.lower(F.replace(text, F.lit(_KELVIN), F.lit(_ANGSTROM)))
    return F.filter(F.split(lowered, DELIMITERS), lambda word: word != "")


def document_frequencies(words: DataFrame) -> dict[str, int]:
    """Texts of words(words) that hold each word of the key phrases; at most as many rows as these have words."""
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for t in TEMPLATES for word in t.key})])
    found = words.select(F.explode(F.array_intersect("words", vocabulary)).alias("word"))
    return {row["word"]: row["count"] for row in found.groupBy("word").count().collect()}


def rare_words(template: Template, frequencies: dict[str, int]) -> list[str]:
    """The key phrase's words of the highest inverse document frequency, those that no text holds first."""
    return sorted(set(template.key), key=lambda word: (frequencies.get(word, 0), word))[:RARE_WORDS]


def positional_index(frequencies: dict[str, int]) -> dict[str, list[tuple[int, int]]]:
    """Postings (template, place) of the rare words in key phrases."""
    index: dict[str, list[tuple[int, int]]] = {}
    for number, template in enumerate(TEMPLATES):
        rare = rare_words(template, frequencies)
        for place, word in enumerate(template.key, template.phrase[0]):
            if word in rare:
                index.setdefault(word, []).append((number, place))
    return index


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _alignments(words: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
    """Alignments that postings propose, as sorted numbers; one occurs as often as postings of its template agree on it."""
    postings = F.create_map(*[c for word, places in sorted(index.items()) for c in (F.lit(word), F.array(*[_long((t << _SHIFT) + _BEFORE - place) for t, place in places]))])
    rare = F.array(*[F.lit(word) for word in sorted(index)])
    placed = F.transform(words, lambda word, at: F.when(word.isin(sorted(index)), F.struct(word.alias("word"), at.alias("at"))))
    hits = F.filter(placed, lambda hit: hit.isNotNull())
    proposed = F.flatten(F.transform(hits, lambda hit: F.transform(F.element_at(postings, hit["word"]), lambda posting: posting + hit["at"])))
    return F.when(F.arrays_overlap(words, rare), F.sort_array(proposed)).otherwise(F.array().cast("array<bigint>"))


def _agreed(ordered: Column, index: dict[str, list[tuple[int, int]]]) -> Column:
    """Of sorted alignments each one that all postings of its template agree on, once."""
    postings = Counter(template for places in index.values() for template, _ in places)
    needed = F.array(*[F.lit(postings[number]) for number in range(len(TEMPLATES))])
    same = lambda code, i: F.get(ordered, i + F.get(needed, F.shiftright(code, _SHIFT).cast("int")) - 1) == code
    # the first of a run of equal numbers, if the run is as long as needed
    return F.filter(ordered, lambda code, i: ((i == 0) | (F.get(ordered, i - 1) != code)) & F.coalesce(same(code, i), F.lit(False)))


def _finds(words: Column, agreed: Column) -> Column:
    """Verified alignments: template, place of the phrase, score."""
    texts = F.array(*[F.array(*[F.lit(word) for word in template.words]) for template in TEMPLATES])
    phrase_at = F.array(*[F.lit(template.phrase[0]) for template in TEMPLATES])
    phrase_size = F.array(*[F.lit(template.phrase[1]) for template in TEMPLATES])

    def check(code: Column) -> Column:
        template = F.shiftright(code, _SHIFT).cast("int")
        place = (code.bitwiseAND(_long((1 << _SHIFT) - 1)) - _BEFORE).cast("int")
        own = F.get(texts, template)
        equal = F.transform(own, lambda word, at: F.get(words, place + at).eqNullSafe(word))
        key = F.slice(equal, F.get(phrase_at, template) + 1, F.get(phrase_size, template))
        share = F.size(F.filter(equal, lambda same: same)) / F.size(own)
        return F.struct(template.alias("template"), (place + F.get(phrase_at, template)).cast("bigint").alias("place"), share.alias("share"), F.forall(key, lambda same: same).alias("whole"))

    return F.filter(F.transform(agreed, check), lambda find: find["whole"] & (find["share"] >= LEAST_SCORE))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and `finds` (template number, place of the key phrase, share of words) of each row; two scans, no shuffle of texts."""
    words = text_of(docs).select("doc_id", words_of(F.col("text")).alias("words"))
    index = positional_index(document_frequencies(words))
    aligned = words.select("doc_id", "words", _alignments(F.col("words"), index).alias("ordered"))
    agreed = aligned.select("doc_id", "words", _agreed(F.col("ordered"), index).alias("agreed"))
    return agreed.select("doc_id", F.size("words").cast("bigint").alias("n_words"), _finds(F.col("words"), F.col("agreed")).alias("finds"))


def license_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    names = F.array(*[F.lit(template.label) for template in TEMPLATES])
    base = F.filter("finds", lambda find: find["template"] < len(BASE))
    places = F.transform(base, lambda find: find["place"])

    def labels(finds: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda find: F.get(names, find["template"])))), ",")

    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("finds")).alias("labels"),
        F.coalesce(F.array_max(F.transform("finds", lambda find: find["share"])), F.lit(0.0)).alias("score"),
    )
