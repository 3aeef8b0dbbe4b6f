"""Poisson replication against its SQL, its means and its edge cases."""

import hashlib
import math
from collections import Counter

import pytest

from surveylake.llm import mixing


def drawn(mean, doc_id, source, seed=mixing.SEED):
    """Copies of a document, in plain Python."""
    key = "-" if source is None else f"={source}"
    parts = max(1, math.ceil(mean / mixing.PART_MEAN))
    total = 0
    for part in range(1, parts + 1):
        digest = hashlib.md5(f"{seed}:{part}:{'' if doc_id is None else doc_id}:{key}".encode()).hexdigest()
        at = (int(digest[:13], 16) + 0.5) / 2**52
        term = reached = math.exp(-mean / parts)
        k = 0
        while reached <= at and k < mixing.MOST:
            k += 1
            term *= mean / parts / k
            reached += term
            total += 1
    return total


ROWS = [(i, f"text {i}", "en", "big" if i % 3 else f"s{i % 7}") for i in range(3000)] + [(None, "a", "en", None), (5001, None, None, None)]


def test_counts_are_the_drawn_ones(documents):
    docs = documents(ROWS)
    means = {r.source_key: r["mean"] for r in mixing.rates(docs, alpha=0.5).collect()}
    got = Counter((r.doc_id, r.source) for r in mixing.mixed(docs, alpha=0.5).collect())
    want = {(i, s): drawn(means["-" if s is None else f"={s}"], i, s) for i, _, _, s in ROWS}
    assert got == Counter({k: n for k, n in want.items() if n})
    assert sum(means["-" if s is None else f"={s}"] for *_, s in ROWS) == pytest.approx(len(ROWS))


def test_target_weights_are_met_also_with_large_means(documents):
    docs = documents([(i, "t", "en", "a" if i < 900 else "b" if i < 950 else "c") for i in range(1000)])
    rows = mixing.mixed(docs, weights={"a": 1, "b": 3}, size=4.0).collect()
    shares = Counter(r.source for r in rows)
    assert set(shares) == {"a", "b"}  # c has no weight
    assert shares["a"] == pytest.approx(1000, abs=5 * math.sqrt(1000)) and shares["b"] == pytest.approx(3000, abs=5 * math.sqrt(3000))
    copies = Counter(r.doc_id for r in rows if r.source == "b")
    spread = sum((n - 60) ** 2 for n in copies.values()) / 50
    assert 25 < spread < 110  # the variance of a Poisson count is its mean, 60


def test_order_is_global_and_repeatable(documents):
    docs = documents(ROWS)
    first, second = (sorted((r.order_key, r.doc_id or -1, r.copy) for r in mixing.mixed(docs).collect()) for _ in range(2))
    assert first == second
    half = [doc for _, doc, _ in first[: len(first) // 2]]
    assert 0.45 < sum(d < 1500 for d in half) / len(half) < 0.55


def test_salted_join_gives_the_same_rows(documents, monkeypatch):
    docs = documents(ROWS)
    want = sorted(map(str, mixing.mixed(docs).collect()))
    monkeypatch.setattr(mixing, "SMALL", 1)
    assert sorted(map(str, mixing.mixed(docs).collect())) == want


def test_edges(documents):
    docs = documents([(1, "t", "en", "a", 7, 8), (1, "t", "en", "a", 7, 8)], ", copy int, mean int")
    out = mixing.mixed(docs, size=3.0)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "mean", "copy", "order_key"]
    assert all(r["mean"] == 8 for r in out.collect()) and out.count() % 2 == 0
    assert mixing.mixed(documents([])).count() == 0 and mixing.mixed(docs, weights={}).count() == 0


def test_native_plan(documents):
    plan = mixing.mixed(documents(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
