"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from quillstream.llm import simhash as op

SCHEMA = "doc_id bigint, text string, fp string, root int, component_id string"


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(run.encode(), seed=42).intdigest() for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(points):
    """points: list of (doc_id, fingerprint)"""
    root = list(range(len(points)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(points)):
        for j in range(i):
            if (points[i][1] ^ points[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(points):
        groups.setdefault(find(i), []).append(doc_id)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(points))]


def documents(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    texts = []
    for _ in range(30):
        base = [word() for _ in range(rng.choice([1, 3, 4, 5, 80, 400]))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = word()
            texts.append(rng.choice([" ", "\n", "\t "]).join(copy).upper())
    texts += [None, "", " \n", " no break", "x" * 5000, "It is"]
    rows = [(i, text, "x", 1, None) for i, text in enumerate(texts)]
    return rows + [rows[0], rows[5], (None, texts[7], "x", 1, None), (None, "all alone here today", None, None, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = documents(seed)
    points = [(row[0], plain_fingerprint(row[1])) for row in rows]
    want = sorted(zip([d for d, _ in points], [f"{fp:016x}" for _, fp in points], plain_components(points)), key=repr)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert sorted((tuple(r) for r in op.near_duplicates(frame).collect()), key=repr) == want
    stays = op.drop_near_duplicates(frame)
    assert stays.columns == frame.columns
    found = stays.collect()
    groups = {}
    for (doc_id, fp), component in zip(points, plain_components(points)):
        groups.setdefault(component if component is not None else fp, []).append(doc_id)
    assert len(found) == len(groups)


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert op.near_duplicates(frame).count() == 0
    assert op.drop_near_duplicates(frame).count() == 0


def test_long_texts_in_slices(monkeypatch):
    text = " ".join(random.Random(3).choices(["ab", "c", "def", "gh\n"], k=500))
    monkeypatch.setattr(op, "SLICE_BYTES", 30)
    assert op.fingerprint(text) == plain_fingerprint(text)


def cluster(rng, n):
    """Fingerprints close to each other and far ones."""
    centres = [rng.getrandbits(64) for _ in range(6)]
    points = set()
    while len(points) < n:
        value = rng.choice(centres) if rng.random() < 0.9 else rng.getrandbits(64)
        for _ in range(rng.randint(0, 6)):
            value ^= 1 << rng.randrange(64)
        points.add(value)
    return sorted(points)


@pytest.mark.parametrize("shape", [(6, 4), (8, 5), (10, 7)])
def test_links_give_the_components_of_all_pairs(spark, monkeypatch, shape):
    monkeypatch.setattr(op, "segments_for", lambda n: shape)
    monkeypatch.setattr(op, "BLOCK", 40)  # so that crowded keys are cut into blocks
    points = cluster(random.Random(shape[0]), 400)
    signed = np.array(points, dtype=np.uint64).view(np.int64).tolist()
    links = op.near_links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    roots = {r.node: r.root for r in op.components(links).collect()}
    wanted = plain_components(list(zip(signed, points)))
    assert [roots.get(v, v) for v in signed] == wanted


def test_every_close_pair_shares_a_key():
    rng = random.Random(4)
    for segments, length in [(6, 4), (8, 5), (10, 7)]:
        masks = op.chain_keys(segments, length)
        differing = np.array([sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(3000)], dtype=np.uint64)
        assert op.chain_holds(differing, segments, length).all()
        assert all(any(int(d) & m == 0 for m in masks) for d in differing)
