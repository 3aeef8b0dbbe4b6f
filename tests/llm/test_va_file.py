"""Top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveylake.llm import va_file

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, k=5):
    good = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(256.0 * x) for x in v):
            good.append((i, [int(np.floor(256.0 * x)) for x in v]))
    out = []
    for i, q in good:
        if i % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q)]
            limit = lambda s: max(-(2**63), min(2**63 - 1, s))
            out += [(i, rank, j, limit(-s)) for rank, (s, j) in enumerate(sorted((-limit(-s), j) for s, j in scored)[:k], 1)]
    return sorted(out)


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in va_file.top_k(frame, F.col("vec_id") % 50 == 0).collect())


def test_random_vectors_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 8).round(1)]) for i in rng.permutation(3000)]
    assert found(spark, rows) == brute(rows)


def test_vectors_that_take_no_part_and_odd_ones(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
        (6, [0.5, 0.5]), (7, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (50, [-1.0, 0.001]), (8, [1e306, 1.0]), (100, [0.0, 0.0]),
        (9, [0.5, 0.5]), (9, [0.5, 0.5]), (150, [1.0, 1.0, 1.0]),
    ]
    assert found(spark, rows) == brute(rows)


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(0, [3e5, 1.0]), (1, [1e11, 7.0]), (2, [1e11, 8.0]), (3, [1e200, 0.0]), (50, [-1e200, 1.0])]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_bounds_hold_and_few_exact_vectors_are_read():
    rng = np.random.default_rng(4)
    exact = np.floor(256 * rng.normal(0, 0.15, (2048, 64)))
    cells, lower, upper = va_file.quantise(exact)
    queries = exact[:20]
    assert (va_file.upper_bounds(queries, cells, lower, upper) >= queries @ exact.T).all()
    search = va_file.Search(np.arange(20), queries, 5)
    search.block(np.arange(2048), exact, cells, lower, upper)
    assert search.exact_reads < 20 * 2048 / 4


@pytest.mark.parametrize("extra", ["place", "score"])
def test_clashing_columns(spark, extra):
    frame = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 2)], f"{SCHEMA}, {extra} int")
    assert va_file.top_k(frame, F.col("vec_id") == 0).count() == 1
