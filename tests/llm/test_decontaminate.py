"""Decontamination against brute force over windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from quillstream.llm import decontaminate as op

DOCS = "doc_id bigint, text string, items string, n_words string, spans boolean"
ITEMS = "item_id bigint, text string, doc_id string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def expected(docs, items, window=13):
    windows = {}
    for item_id, text, *_ in items:
        own = words(text)
        n = min(window, len(own))
        for at in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[at : at + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text, *_ in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for at in range(len(own) - n + 1):
                if (owners := windows.get(tuple(own[at : at + n]))) is not None:
                    hit.update(range(at, at + n))
                    found |= owners
        found.discard(None)
        listed = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)))
    return sorted(out, key=repr)


def report(spark, docs, items):
    found = op.contamination_report(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    return sorted((tuple(row) for row in found.collect()), key=repr)


def prose(rng, n, letters="abcd"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 2))) for _ in range(n))


def cases(seed):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([0, 3, 9, 13, 14, 40])), "x") for i in range(12)]
    items += [(20, items[5][1], "x"), (None, prose(rng, 30), "x"), (21, None, "x"), (22, "Dé-jà VU", "x")]
    docs = [(i, prose(rng, rng.randint(0, 60)), "x", "y", True) for i in range(40)]
    for i in range(40, 80):
        item = rng.choice(items)[1] or ""
        docs.append((i, f"{prose(rng, rng.randint(0, 300))}. {item.upper()}!{prose(rng, 5)}", "x", "y", True))
    docs += [(90, None, "x", "y", True), (91, "", None, None, None), (None, "dé jà vu", "x", "y", True)]
    docs += [docs[50], docs[50], (92, " ".join([docs[50][1]] * 300), "x", "y", False)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    docs, items = cases(seed)
    assert report(spark, docs, items) == expected(docs, items)


def test_blocks_and_slices_change_nothing(spark, monkeypatch):
    docs, items = cases(3)
    monkeypatch.setattr(op, "SLICE_BYTES", 40)
    assert op.search_shard([d[1] or "" for d in docs], op.index_items([i[:2] for i in items])).counts.tolist() == [len(words(d[1])) for d in docs]
    found = op.contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=100)
    rows = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in found.collect()), key=repr)
    assert rows == sorted((row[:4] for row in expected(docs, items)), key=repr)


def test_empty_tables(spark):
    docs, items = cases(4)
    assert report(spark, [], items) == []
    assert report(spark, docs, []) == expected(docs, [])


def test_affected_documents_go(spark):
    docs, items = cases(5)
    frame = spark.createDataFrame(docs, DOCS)
    kept = op.drop_contaminated(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame.columns
    clean = [row[0] for row in expected(docs, items) if not row[-1]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_suffix_array_and_longest_matches():
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(["a", "b", "c", "zz"], 60)) for _ in range(5)]
    bench = op.index_items([(0, " ".join(rng.choice(["a", "b", "c"], 50)))], window=4)
    ids = np.concatenate([np.r_[[bench.numbers.get(w.encode(), 0) for w in text.split()], 0] for text in texts]).astype(np.int64)
    order = op.suffix_array(ids, op._positions(ids, 4), 50)
    suffix = lambda at: ids[at : at + int(np.argmin(ids[at:] != 0))].tolist()
    assert [suffix(a) for a in order] == sorted(suffix(a) for a in order)
    longest, place, _ = op.search(ids, order, bench)
    test = bench.words[:-1].tolist()
    for at in range(50):
        best = max(next((k for k, (x, y) in enumerate(zip(suffix(p) + [0], test[at:] + [-1])) if x != y), 0) for p in order)
        assert longest[at] == best
        if best:
            assert ids[place[at] : place[at] + best].tolist() == test[at : at + best]
