"""Licence scans against brute force over all places."""

import random
import re

import pytest

from quillstream.llm import licenses as op

SCHEMA = "doc_id bigint, text string, labels string, words int"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(rows):
    texts = [words(text) for _, text, *_ in rows]
    out = []
    for (doc_id, *_), own in zip(rows, texts):
        base, labels, best = [], set(), 0.0
        for t in op.TEMPLATES:
            for place in range(-len(t.words), len(own)):
                same = [0 <= place + i < len(own) and own[place + i] == w for i, w in enumerate(t.words)]
                at, size = t.phrase
                if all(same[at : at + size]) and sum(same) / len(same) >= op.LEAST_SCORE:
                    labels.add(t.label)
                    best = max(best, sum(same) / len(same))
                    if t.base:
                        base.append((place, t.label))
        places = [place for place, _ in base]
        out.append((doc_id, len(own), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in base})), ",".join(sorted(labels)), best))
    return sorted(out, key=repr)


def check(spark, rows):
    found = op.license_report(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


CASES = [
    "Licensed under the Apache License, Version 2.0.", "apache license version 2 0 and no more", "CC BY cc by cc-by! CC  BY-NC 4.0",
    "This work is licensed under the GNU General Public License, version 3.", "general public general public license license",
    "all rights reserved all rights all rights reserved", "Released under the MIT License", "x mit license", None, "", "...", "li" + chr(0x130) + "cense",
    "all rights " + chr(0x212A) + " reserved", "ALL RIGHTS RÉSERVED", "by cc", "cc", "license " * 3000, "cc by " * 3000,
    "é" * 5000 + " all rights reserved", "Permission is hereby granted, free of charge, to any one who obtains a copy",
]


def test_cases(spark):
    rows = [(i, text, "x", 1) for i, text in enumerate(CASES)]
    check(spark, rows + [rows[0], (None, "cc by", None, None), (3, "cc by 4.0", "x", 1)])


def test_a_find_does_not_depend_on_other_rows(spark):
    texts = ["This is free and unencumbered software", "CC BY 4.0", " ".join(next(t for t in op.NOTICES if len(t.words) > 60).words)]
    others = ["domain", "domain released", "released into the public", "licensed", "under licensed", "free software is this", "4 0 by"]
    for extra in ([], others, others * 3):
        rows = [(i, text, "x", 1) for i, text in enumerate(texts + extra)]
        check(spark, rows)
        found = {r.doc_id: (r.labels, round(r.score, 3)) for r in op.license_report(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert [found[0], found[1]] == [("unlicense", 0.545), ("cc-by,cc-by-4.0", 1.0)]
        assert "mit" in found[2][0] and found[2][1] == 1.0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    pool = [w for t in op.TEMPLATES for w in t.words] + ["lorem", "ipsum"] * 8
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 8)):
            own = list(rng.choice(op.TEMPLATES).words)
            if rng.random() < 0.6:
                own[rng.randrange(len(own))] = rng.choice(pool)
            parts += own[rng.randint(0, 3) :] if rng.random() < 0.3 else own
            parts += rng.choices(pool, k=rng.randint(0, 6))
        texts.append(rng.choice([" ", ", ", "\n"]).join(parts).upper())
    check(spark, [(i, text, "x", 1) for i, text in enumerate(texts)])


def test_empty_table_and_plan(spark):
    found = op.license_report(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))
