"""Patterns as data against every pattern on every name; overlaps of blocks against counting."""

import random
import re

import pytest
from pyspark.sql import functions as F

from surveylake.functions.rules import CANONICAL_FIELDS
from surveylake.operators import quality
from surveylake.operators.pattern_index import match_patterns, required_words

WORDS = {
    r"^p0_id$": ["p0", "id"], r"^p2_[a-z]_nivel$": ["p2", "nivel"], r"uf_onde_mora": ["onde"], r"ideal": [],
    r"^p2_a_": ["p2", "a"], r"_(em|na_area)_dados_": ["dados"], r"^a_b|_c_": [], r"(?i)^a_b_": [], r"_ab?_c_": ["c"],
    r"_x{2}_yy_": ["yy"], r"^p\d+_q_$": ["q"], r"_((a|b)_c)?_d_": ["d"], r"_\x41_b_": [], r"_a_\$": ["a"], r"": [], r"_a.c_": [],
    r"^a\|b_c_": ["c"], r"_a_(b_c_": [], r"^(a_b)+_c$": ["c"], r"^fim\.$": [], r"_nao_*sei_": [], r"_a+?_b_": ["b"],
}


def test_words_that_every_match_has(spark):
    df = spark.createDataFrame([(p,) for p in WORDS], "pattern string")
    got = {r.pattern: sorted(r.w) for r in df.select("pattern", required_words(F.col("pattern")).alias("w")).collect()}
    assert got == {p: sorted(w) for p, w in WORDS.items()}


def test_matches_equal_those_of_all_patterns_on_all_names(spark):
    rng = random.Random(5)
    pool = ["p2", "a", "b", "c", "ab", "id", "nivel", "onde", "mora", "uf", "dados", "em", "ideal", "p0", "x", "yy", "d"]
    names = ["_".join(rng.choice(pool) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    names += ["p0_id", "p2_a_nivel", "uf_onde_mora", "", None, "p0_id", "_a_b_", "a__b", "p0_id\n", "x-onde mora"] + names[:50]
    patterns = [p for p in WORDS if p not in (r"_a_(b_c_",)] + [p for spec in CANONICAL_FIELDS for p in spec.patterns] + [r"^\w+_dados$", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "row int, name string")
    rules = spark.createDataFrame([(i, p) for i, p in enumerate(patterns)], "rule int, pattern string")
    got = sorted((r.row, r.rule) for r in match_patterns(df, rules).collect())
    read = [None if p is None else re.compile(p) for p in patterns]
    assert got == sorted((i, j) for i, n in enumerate(names) for j, p in enumerate(read) if n is not None and p is not None and p.search(n))
    assert match_patterns(df.limit(0), rules).count() == match_patterns(df, rules.limit(0)).count() == 0
    with pytest.raises(ValueError, match="row"):
        match_patterns(df, rules.withColumnRenamed("rule", "ROW"))


def test_overlaps_of_all_blocks(spark):
    rng = random.Random(8)
    rows = [(rng.choice([1, 2, None]), *(rng.choice([None, "x"]) for _ in range(5))) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, " + ", ".join(f"b{i} string" for i in range(5)))
    blocks = {f"b{i}": F.col(f"b{i}").isNotNull() for i in range(5)} | {"none": F.lit(False), "unknown": F.col("b0") == F.lit(None)}
    patterns = quality.answer_patterns(df, ["k"], blocks)
    got = {(r.k, r.bloco, r.outro): (r.primeiro, r.segundo, r.ambos) for r in quality.block_overlaps(patterns, ["k"], list(blocks)).collect()}
    assert len(got) == 3 * 21
    for (k, a, b), counts in got.items():
        has = lambda row, name: name[0] == "b" and row[int(name[1]) + 1] is not None
        own = [row for row in rows if row[0] == k]
        assert counts == (sum(has(r, a) for r in own), sum(has(r, b) for r in own), sum(has(r, a) and has(r, b) for r in own))
    assert quality.block_overlaps(quality.answer_patterns(df.limit(0), ["k"], blocks), ["k"], list(blocks)).count() == 0
    with pytest.raises(ValueError):
        quality.answer_patterns(df, ["k"], {})
