import math
import random
from collections import defaultdict
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.operators import compare, quality, ranking, segments


@pytest.fixture(scope="module")
def people(spark):
    """One segment holds more than half of the rows; another has one row, one only NULLs."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = rng.choice([None, 0.0, -5.5, 7.25, rng.uniform(-1e6, 1e6), rng.uniform(1, 2)])
        rows.append((i, rng.choice([1, 2]), key, rng.choice(["p", "q", None]), value))
    rows += [(6000, 1, "single", "p", 4.0), (6001, 1, "empty", "p", None)]
    return spark.createDataFrame(rows, "id int, year int, k string, g string, v double").cache()


def brute(rows, p):
    ordered = sorted(rows)
    return ordered[max(1, math.ceil(p * len(ordered))) - 1]


@pytest.mark.parametrize("exact", [True, False])
def test_segment_stats_against_brute_force(people, exact):
    groups = defaultdict(list)
    for row in people.collect():
        if row["v"] is not None:
            groups[(row["year"], row["k"])].append(row["v"])
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    stats = segments.segment_stats(people, ["year", "k"], "v", points, exact=exact, accuracy=100_000)
    got = {(row["year"], row["k"]): row for row in stats.collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        assert got[key]["respondentes"] == len(values)
        assert got[key]["salario_medio"] == pytest.approx(sum(values) / len(values), abs=0.02)
        assert got[key]["amostra_suficiente"] == (len(values) >= 30)
        for name, p in points.items():
            assert got[key][name] == pytest.approx(brute(values, p), abs=0.006)


def test_exact_percentiles_of_extreme_values(spark):
    values = [float("-inf"), -1e300, -1e-300, -0.0, 1e-300, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    points = {f"p{i}": i / 8 for i in range(1, 9)}
    row = segments.exact_percentiles(df, [], "v", points).first()
    assert [row[f"p{i}"] for i in range(1, 8)] == values[:7]
    assert math.isnan(row["p8"]) and row["n"] == 8


def test_multi_cut_equals_single_cuts(people):
    cuts = {"k": "k", "g": "g"}
    together = segments.multi_cut_stats(people, ["year"], cuts, "v")
    apart = reduce(
        DataFrame.unionByName,
        [
            segments.segment_stats(people.where(F.col(c).isNotNull()), ["year", c], "v")
            .withColumnRenamed(c, "categoria")
            .withColumn("dimensao", F.lit(c))
            for c in cuts
        ],
    )
    assert quality.table_difference(together, apart).count() == 0


def test_adoption_equals_join_with_base(spark):
    rows = [(1, ["x", "y", "x"]), (1, []), (1, None), (2, ["", None, "y"]), (3, None), (None, ["x", "x"]), (None, ["z"])]
    df = spark.createDataFrame(rows, "year int, items array<string>")
    once = segments.adoption(df, ["year"], {"c": "items"}).drop("categoria", "pct_adocao")
    joined = segments.adoption_with_base_join(df, ["year"], "items").select(*once.columns)
    assert quality.table_difference(once, joined).count() == 0
    df = df.where("year is not null")
    deduped = segments.adoption(df, ["year"], {"c": "items"}).orderBy("year", "tecnologia").collect()
    assert [(r["year"], r["tecnologia"], r["usuarios"], r["base_respondentes"]) for r in deduped] == [
        (1, "x", 1, 2), (1, "y", 1, 2), (2, "y", 1, 1)
    ]


def test_rates_tell_missing_from_no(people):
    flags = {"pct": F.col("v") > 0}
    answered = segments.rate_among_answered(people, ["k"], flags)
    as_no = segments.rate_among_answered(people, ["k"], flags, null_as_false=True)
    assert answered.where("k = 'empty'").first()["pct"] is None
    assert as_no.where("k = 'empty'").first()["pct"] == 0.0


def test_shares_add_up(people):
    counted = people.groupBy("year", "k").agg(F.count(F.lit(1)).alias("n"))
    shared = compare.share_within(counted, "n", ["year"], "pct")
    for row in shared.groupBy("year").agg(F.sum("pct").alias("s")).collect():
        assert row["s"] == pytest.approx(100, abs=0.05)


def test_index_and_gap_agree(people):
    medians = segments.segment_stats(people, ["year", "k"], "v", {"m": 0.9}).where("m > 0")
    gap = compare.gap_to_reference(medians, "m", "k", "hot", ["year"], "gap", digits=6)
    both = compare.gap_to_reference(gap, "m", "k", "hot", ["year"], "idx", kind="index", digits=6)
    for row in both.collect():
        assert row["idx"] - 100 == pytest.approx(row["gap"], abs=1e-5)


def test_premium_base_is_first_level_present(spark):
    df = spark.createDataFrame([(1, "b", 10.0), (1, "c", 15.0), (2, "a", 0.0), (2, "c", 5.0)],
                               "year int, level string, m double")
    got = compare.premium_vs_first(df, "m", ["year"], "level", ["a", "b", "c"], "p").orderBy("year", "level")
    assert [row["p"] for row in got.collect()] == [0.0, 50.0, None, None]


def test_top_k_of_latest_edition(people):
    top = compare.top_k(people.where("v is not null"), ["k"], [F.desc("v"), F.asc("id")], 3, latest_of="year")
    groups = defaultdict(list)
    for row in people.where("v is not null").collect():
        groups[row["k"]].append(row)
    expected = set()
    for key, rows in groups.items():
        last = max(row["year"] for row in rows)
        ordered = sorted((r for r in rows if r["year"] == last), key=lambda r: (-r["v"], r["id"]))
        expected |= {(key, row["id"]) for row in ordered[:3]}
    assert {(row["k"], row["id"]) for row in top.collect()} == expected


def test_reindex_keeps_missing_categories(spark):
    df = spark.createDataFrame([("b", 1)], "c string, n int")
    rows = compare.reindex(df, "c", ["a", "b"]).orderBy("posicao").collect()
    assert [(row["c"], row["n"]) for row in rows] == [("a", None), ("b", 1)]


def test_number_in_group_over_ranges(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else "b", rng.choice(["f", "g"]), p) for p in range(500)]
    df = spark.createDataFrame(rows, "k string, f string, p int")
    got = ranking.number_in_group(df, ["k"], "p", "n", width=7, within=["f"]).collect()
    expected, count = {}, defaultdict(int)
    for k, f, p in sorted(rows):
        count[k] += 1
        expected[(k, f, p)] = count[k]
    assert {(r["k"], r["f"], r["p"]): r["n"] for r in got} == expected


def test_table_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    right = spark.createDataFrame([("a", 1), (None, 2), (None, 2)], "y string, x int")
    got = {(row["x"], row["y"]): row["sobra"] for row in quality.table_difference(left, right).collect()}
    assert got == {(1, "a"): 1, (2, None): -1}


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "x int, y string")
    fill = {row["coluna"]: (row["preenchidas"], row["toda_nula"]) for row in quality.column_fill(df).collect()}
    assert fill == {"x": (2, False), "y": (0, True)}
    assert quality.is_empty(df.where("x > 5"), "t").first()["vazia"]
    report = quality.query_report({"a": df, "b": df.where("x > 5"), "c": df.select("x")}).collect()
    assert {row["consulta"]: row["status"] for row in report} == {"a": "FALHA", "b": "FALHA", "c": "OK"}
    contract = quality.contract_report(df, {"x": "int", "y": "int", "z": "string"})
    assert {row["coluna"]: row["confere"] for row in contract.collect()} == {"x": True, "y": False, "z": False}


@pytest.mark.parametrize("shift", [0.0, 1.7e9, 1e-9])
def test_exact_percentiles_of_narrow_ranges(spark, shift):
    scale = 1e-12 if shift == 1e-9 else 1e-3
    values = [shift + scale * ((i * 7919) % 5000) for i in range(5000)]
    df = spark.createDataFrame([("hot", v) for v in values] + [(None, 1.0)], "k string, v double")
    points = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    rows = {r["k"]: r for r in segments.exact_percentiles(df, ["k"], "v", points).collect()}
    assert [rows["hot"][p] for p in points] == [brute(values, q) for q in points.values()]
    assert rows[None]["p50"] == 1.0


def test_exact_percentiles_keep_long_values(spark):
    values = [2**60 + i for i in range(0, 2000, 3)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    row = segments.exact_percentiles(df, [], "v", {"p10": 0.1, "p50": 0.5, "p90": 0.9}).first()
    assert [row["p10"], row["p50"], row["p90"]] == [brute(values, q) for q in (0.1, 0.5, 0.9)]


def test_unexpected_editions_are_reported(spark):
    df = spark.createDataFrame([(1995, "a"), (1996, "a"), (1996, "a"), (2003, "b"), (None, "c")], "survey_year int, respondente_id string")
    rows = {r["survey_year"]: tuple(r)[1:] for r in quality.edition_report(df, (1996, 1997)).collect()}
    assert rows == {
        1995: (False, 1, 1, 0), 1996: (True, 2, 1, 1), 1997: (True, 0, 0, 0), 2003: (False, 1, 1, 0), None: (False, 1, 1, 0)
    }


def test_tables_with_other_columns_are_not_compared(spark):
    left = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        quality.table_difference(left, spark.createDataFrame([(1, 2)], "a int, b int"))


def test_first_level_is_one_of_a_kind(spark):
    df = spark.createDataFrame([(1, "y", 10.0), (1, "x", 20.0)], "year int, level string, v double")
    rows = compare.premium_vs_first(df, "v", ["year"], "level", ["a"], "premium").collect()
    assert {r["level"]: r["premium"] for r in rows} == {"x": 0.0, "y": -50.0}
