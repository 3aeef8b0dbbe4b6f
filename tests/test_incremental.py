"""Ledger, refresh by edition, digest trees, stored sketches and answers that no rule knows."""

import random

import pytest
from pyspark.sql import functions as F

from surveylake.functions import text as X
from surveylake.functions.rules import SENIORITY_RULES, SILVER_COLUMNS
from surveylake.operators import digest, quality, sketches, unmatched
from surveylake.plans.marts import MARTS, build_mart
from surveylake.sources import gold, ledger


def export(folder, year, rows, name="pesquisa"):
    body = "".join(f'{i},"linha\n{i}"\n' for i in rows)
    (folder / f"{name}_{year}.csv").write_text("0.a_token,9.z_comentario\n" + body, encoding="utf-8")


def test_a_second_run_writes_nothing_and_changes_touch_their_edition_only(spark, tmp_path):
    raw, out, book = tmp_path / "raw", str(tmp_path / "bronze"), str(tmp_path / "ledger")
    raw.mkdir()
    for year in (2023, 2024, 2025):
        export(raw, year, range(year - 2000))

    def run():
        found = ledger.ingest_changes(spark, str(raw), out, book)
        return found.written, [kind for _, _, kind in found.exports]

    def rows():
        return {row[0]: row[1] for row in spark.read.parquet(out).groupBy("survey_year").count().collect()}

    def written_at():
        return {path.parent.name: path.stat().st_mtime_ns for path in (tmp_path / "bronze").rglob("*.parquet")}

    assert run() == ({2023: 23, 2024: 24, 2025: 25}, ["nova"] * 3)
    before = written_at()
    assert run() == ({}, ["igual"] * 3) and written_at() == before
    export(raw, 2024, range(5))
    export(raw, 2025, range(100, 103), "segunda")
    assert run() == ({2024: 5, 2025: 28}, ["igual", "substituida", "igual", "nova"])
    assert written_at()["survey_year=2023"] == before["survey_year=2023"] and rows() == {2023: 23, 2024: 5, 2025: 28}
    (raw / "segunda_2025.csv").unlink()
    (raw / "pesquisa_2023.csv").unlink()
    assert run() == ({}, ["retirada", "igual", "igual", "retirada"])  # reported, nothing is dropped unasked
    export(raw, 2025, range(4))
    assert run() == ({2025: 4}, ["retirada", "igual", "substituida", "retirada"])
    assert rows() == {2023: 23, 2024: 5, 2025: 4} and run()[0] == {}


def silver_rows(spark, year, n, seed):
    rng = random.Random(seed)
    picks = {
        "cargo": ["Cientista de Dados", "Analista de Dados", None], "senioridade": ["Júnior", "Pleno", "Sênior", None],
        "genero": ["Masculino", "Feminino", None], "regiao": ["Sul", "Norte", None], "modelo_trabalho": ["Remoto", "Híbrido"],
        "resultado_ia_empresa": ["Piloto", None],
    }
    kinds = {
        "string": lambda name: rng.choice(picks.get(name, ["x", None])), "int": lambda name: rng.randint(18, 60),
        "double": lambda name: rng.choice([None, 1000.0 * rng.randint(1, 30)]), "boolean": lambda name: rng.choice([True, False, None]),
        "array<string>": lambda name: rng.choice([None, [], ["SQL"], ["SQL", "Python"]]),
    }
    rows = [(year, *(kinds[kind](name) for name, kind in SILVER_COLUMNS.items())) for _ in range(n)]
    return spark.createDataFrame(rows, "survey_year int, " + ", ".join(f"`{c}` {k}" for c, k in SILVER_COLUMNS.items()))


def test_refreshed_marts_equal_a_full_build(spark, tmp_path):
    silver, out = str(tmp_path / "silver"), str(tmp_path / "gold")

    def store(year, seed):
        frame = silver_rows(spark, year, 150, seed).drop("survey_year")
        frame.write.mode("overwrite").parquet(f"{silver}/survey_year={year}")

    def check():
        whole = spark.read.parquet(silver)
        for name in MARTS:
            built = build_mart(name, whole)
            stored = spark.read.parquet(f"{out}/{name}").select(*built.columns)
            assert quality.table_difference(built, stored).count() == 0, name

    def files(year):
        return {str(path): path.stat().st_mtime_ns for path in (tmp_path / "gold").rglob("*.parquet") if f"={year}" in str(path)}

    for year in (2023, 2024, 2025):
        store(year, year)
    assert gold.refresh_marts(spark, silver, out) == {"written": [2023, 2024, 2025], "removed": []}
    check()
    before = files(2023)
    assert gold.refresh_marts(spark, silver, out) == {"written": [], "removed": []}
    store(2024, 7)
    assert gold.refresh_marts(spark, silver, out) == {"written": [2024], "removed": []}
    assert files(2023) == before
    check()
    gone = tmp_path / "silver" / "survey_year=2025"
    for path in gone.iterdir():
        path.unlink()
    gone.rmdir()
    assert gold.refresh_marts(spark, silver, out) == {"written": [], "removed": [2025]}
    check()


def test_digests_name_the_rows_that_differ(spark):
    rng = random.Random(4)
    rows = [(i % 40, rng.choice([None, "a", "b"]), rng.choice([None, 1.5, 2.0]), None) for i in range(2000)]
    schema = "k int, s string, d double, n string"
    left = spark.createDataFrame(rows, schema)
    other = [row for i, row in enumerate(rows) if i not in (3, 700)] + [(99, "new", None, None), rows[0], (5, None, 1.5, "a")]
    right = spark.createDataFrame(other, schema).select("d", "k", "n", "s").repartition(5)
    for buckets, fan in ((64, 8), (5, 2), (digest.BUCKETS, digest.FAN)):
        found = digest.digest_difference(left, right, buckets, fan)
        want = quality.table_difference(left, right)
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert digest.digest_difference(left, left.repartition("s")).count() == 0
    assert digest.differing_buckets(digest.bucket_digests(left), digest.bucket_digests(left.repartition(3))).count() == 0
    with pytest.raises(ValueError):
        digest.digest_difference(left, right.drop("n"))


def test_digests_tell_nulls_and_repeats_apart(spark):
    frames = [[(None, "a")], [("a", None)], [("a", "a")], [("a", "a")] * 2, [("a", "a")] * 3, []]
    sums = {tuple(map(tuple, digest.bucket_digests(spark.createDataFrame(f, "x string, y string"), buckets=1).collect())) for f in frames}
    assert len(sums) == len(frames)


def test_stored_sketches_add_up(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice((2023, 2024, 2025)), rng.choice(["a", "b", None]), rng.choice(["x", "y"]), rng.choice([None, rng.lognormvariate(9, 1)])) for _ in range(6000)]
    df = spark.createDataFrame(rows, "survey_year int, cargo string, regiao string, salario_medio_mensal double")
    cuts = {"cargo": ["cargo"], "regiao e cargo": ["regiao", "cargo"]}
    sketches.cut_states(df, ["survey_year"], cuts).write.partitionBy("survey_year").parquet(str(tmp_path / "states"))
    stored = spark.read.parquet(str(tmp_path / "states")).where("survey_year in (2023, 2025)")
    found = sketches.state_stats(sketches.merged_states(stored, ["dimensao", "categorias"])).collect()
    assert len(found) == 3 + 6
    for row in found:
        picked = [
            s for y, c, r, s in rows
            if y != 2024 and s is not None and row.categorias == ([c] if row.dimensao == "cargo" else [r, c])
        ]
        assert row.respondentes == len(picked) and row.salario_medio == pytest.approx(sum(picked) / len(picked), abs=0.01)
        for name, p in sketches.PERCENTILES.items():
            below = sum(s < row[name] - 0.01 for s in picked) / len(picked)
            upto = sum(s <= row[name] + 0.01 for s in picked) / len(picked)
            assert below - sketches.RANK_ERROR <= p <= upto + sketches.RANK_ERROR


def test_answers_no_rule_knows(spark):
    answers = ["Júnior", "pleno ", "Nível 7", "nível 7", "nan", "", None, "Guru", "Guru", "Sênior"]
    df = spark.createDataFrame([(a, "sim" if a else "talvez") for a in answers], "nivel string, muda string")
    fields = {
        "nivel": unmatched.by_rules("nivel", SENIORITY_RULES),
        "muda": unmatched.by_value("muda", X.yes_no(X.clean_text(F.col("muda")))),
        "vazio": unmatched.by_rules("nivel", [(".*", "x")]),
    }
    rows = {row.campo: row for row in unmatched.unmatched_answers(df, fields).collect()}
    level = rows["nivel"]
    assert (level.respondidas, level.sem_regra, level.pct_sem_regra, level.grafias) == (7, 4, 57.14, 3)
    assert level.principais[0] == ("Guru", 2) and {tuple(p) for p in level.principais[1:]} == {("Nível 7", 1), ("nível 7", 1)}
    assert (rows["muda"].respondidas, rows["muda"].sem_regra) == (10, 2) and rows["muda"].principais == [("talvez", 2)]
    assert rows["vazio"].sem_regra == 0 and not rows["vazio"].principais
    assert unmatched.unmatched_answers(df.limit(0), fields).count() == 3
