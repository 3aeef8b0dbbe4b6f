"""Signatures against exact similarities; classes against brute force."""

import random
from collections import Counter

import numpy as np

from surveylake.llm import bag_minhash as near
from surveylake.llm.components import components


def bag(text):
    words = text.lower().encode().split()
    width = min(near.SIZE, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else None


def brute(rows):
    """Smallest id of each row's class, by all pairs and merged sets."""
    bags = [bag(t or "") for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i] == rows[j]:
                same = True
            elif bags[i] is None or bags[j] is None:
                same = False
            else:
                shared = sum((bags[i] & bags[j]).values())
                same = 5 * shared >= 4 * (sum(bags[i].values()) + sum(bags[j].values()) - shared)
            if same:
                group[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return [ids.get(find(i)) for i in range(len(rows))]


def test_collisions_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        values = np.unique(rng.integers(0, 2**62, rng.integers(5, 150)).astype(np.uint64))
        weights = rng.integers(1, 40, len(values))
        other = np.where(rng.random(len(values)) < 0.3, rng.integers(1, 40, len(values)), weights)
        keep = rng.random(len(values)) < 0.9
        a, b = (values, weights), (values[keep], other[keep])
        signature = near.signatures([a, b], 500)
        errors.append((signature[0] == signature[1]).mean() - near.similarity(a, b))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_exact_similarity():
    a = (np.array([1, 2, 3], dtype=np.uint64), np.array([1, 4, 2]))
    b = (np.array([2, 3, 9], dtype=np.uint64), np.array([2, 5, 1]))
    assert near.similarity(a, b) == 4 / (7 + 8 - 4)


def test_overlaps_are_those_of_the_multisets():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(30)]
    sets = [near._elements(t) for t in texts]
    got = near.overlaps(sets, np.arange(10), np.arange(10, 30))
    bags = [bag(t) for t in texts]
    assert got.tolist() == [[sum((bags[i] & bags[j]).values()) for j in range(10, 30)] for i in range(10)]


def edited(rng, words, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = words(1)[0]
    return out


def cases(words):
    rng = random.Random(3)
    rows = []
    for _ in range(25):
        base = words(rng.randint(30, 200))
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            rows.append(" ".join(edited(rng, words, base, rng.randint(0, 4))))
    hot = words(120)
    rows += [" ".join(edited(rng, words, hot, rng.randint(1, 3))) for _ in range(120)]
    rows += ["x y " * 40, "x y " * 44, "x y " * 60, "one two", "One  two", "one two three", "", None, " \n", "", "a"]
    rows += [" ".join(hot)] * 30
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows)) + [(None, "no id here at all today"), (ids[0], rows[0]), (None, rows[3])]


def test_classes_match_all_pairs(documents, words):
    rows = cases(words)
    want = Counter((doc_id, cls) for (doc_id, _), cls in zip(rows, brute(rows)))
    found = near.classes(documents(rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == want


def test_small_blocks_and_products_lose_nothing(documents, words, monkeypatch):
    rows = cases(words)
    monkeypatch.setattr(near, "BLOCK", 7)
    monkeypatch.setattr(near, "COLUMNS", 50)
    monkeypatch.setattr(near, "GROUP", 3)
    found = near.classes(documents(rows)).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == Counter((i, c) for (i, _), c in zip(rows, brute(rows)))


def test_one_row_of_each_class_stays(documents, words):
    rows = cases(words)
    docs = documents([(*row, "en", "s", n) for n, row in enumerate(rows)], ", near_key int")
    kept = near.deduplicated(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    classes = brute(rows)
    got = kept.collect()
    place = {r.near_key: classes[r.near_key] for r in got}
    named = [c for c in place.values() if c is not None]
    assert len(named) == len(set(named)) and set(named) == {c for c in classes if c is not None}
    assert all(r.doc_id == classes[r.near_key] for r in got)


def test_empty_table(documents):
    assert near.classes(documents([])).count() == 0 and near.deduplicated(documents([])).count() == 0


def test_components_on_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, n) for n in range(101, 160)] + [(200, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 160)} == {100} and found[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
