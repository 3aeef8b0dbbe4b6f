"""Raw CSV exports with every known oddity, through Bronze, Silver, Gold and the catalog."""

import csv
import os

import pytest

from pyspark.sql import functions as F

from surveylake.bindings.editions import export_raw
from surveylake.bindings.tables import WORDS, respondents
from surveylake.functions.rules import GOLD_COLUMNS, SILVER_COLUMNS
from surveylake.plans.analytics import QUERIES
from surveylake.plans.frames import FRAMES
from surveylake.plans.lake import Lake
from surveylake.plans.marts import MARTS, build_mart
from surveylake.session import scratch_path
from surveylake.sources import bronze, gold, silver

SF_DIR = "/root/testdata/sf0.001"
OLD = ["('P0', 'id')", "('P1_a ', 'Idade')", "('P1_b ', 'Genero')", "('P2_f ', 'Cargo Atual')",
       "('P2_g ', 'Nivel')", "('P2_h ', 'Faixa salarial')",
       "('P4_d ', 'Linguagem de programação (dia a dia)')", "('P4_d_1 ', 'SQL')",
       "('P4_d_2 ', 'Não utilizo nenhuma')", "('P4_d_3 ', 'C/C++/C#')", "('P9', 'Comentário, livre')",
       "Unnamed: 0"]
NEW = ["0.a_token", "1.a_idade", "1.b_genero", "1.i.1_uf_onde_mora", "2.f_cargo_atual", "2.h_nivel",
       "2.i_faixa_salarial", "2.r_modelo_de_trabalho_atual", "2.s_modelo_de_trabalho_ideal",
       "4.m_usa_chatgpt_ou_copilot_no_trabalho?", "4.h_cloud_dia_a_dia",
       "4.h.1_amazon_web_services_aws"]


@pytest.fixture(scope="module")
def home(spark):
    root = scratch_path(spark, "pipeline")
    os.makedirs(f"{root}/raw")

    def export(name, header, rows):
        with open(f"{root}/raw/{name}", "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out)
            writer.writerow(header)
            writer.writerows(rows)

    same = ["", "nan", "Feminino ", "Outra Opção", "-", "Menos de R$ 1.000/mês", "", "0", "1", "0", "", ""]
    export("survey_2023.csv", OLD, [
        ["r1", "25.0", "Masculino", "Data Engineer", "JÚNIOR", "de R$ 4.001/mês a R$ 6.000/mês", "",
         "1", "0", "1", 'linha 1\nlinha "2"', "7"],
        ["r1", "26", "Masculino", "Data Engineer", "Pleno", "Acima de R$ 40.001/mês", "", "", "", "", "x", ""],
        same, same,
    ])
    # A second export of the same edition, with another header.
    export("survey 2023+b.CSV", OLD[:3], [["r9", "40", "Mulher"]])
    export("survey_2024_2025.csv", NEW, [
        ["t1", "30", "Homem", "sp", "Analista de BI", "Senior", "não recebo",
         "Modelo híbrido com dias fixos presencial", "100% remoto", "Não utilizo nenhum tipo", "", "sim"],
    ])
    export("notes.txt", ["a"], [["ignored"]])
    return root


def test_chain(spark, home):
    report = bronze.ingest(spark, f"{home}/raw", f"{home}/bronze")
    assert {year: part["rows"] for year, part in report.items()} == {2023: 5, 2024: 1}
    assert bronze.bronze_editions(spark, f"{home}/bronze") == [2023, 2024]
    exports = bronze.read_edition(spark, f"{home}/bronze", 2023).select("arquivo_origem").distinct()
    assert {row[0] for row in exports.collect()} == {"survey_2023.csv", "survey 2023+b.CSV"}
    comments = bronze.read_edition(spark, f"{home}/bronze", 2023).select("p9_comentario_livre")
    assert 'linha 1\nlinha "2"' in [row[0] for row in comments.collect()]
    assert "unnamed_0" not in bronze.read_edition(spark, f"{home}/bronze", 2023).columns

    people = silver.conform(spark, f"{home}/bronze")
    assert silver.write_silver(people, f"{home}/silver") == 5
    stored = spark.read.parquet(f"{home}/silver")
    assert dict(stored.dtypes) == {**SILVER_COLUMNS, "survey_year": "int"}
    rows = {row["respondente_id"]: row for row in stored.collect()}
    first = rows["r1"]
    assert (first["idade"], first["cargo"], first["senioridade"], first["salario_medio_mensal"]) == (
        25, "Engenheiro de Dados", "Júnior", 5000.5)
    assert first["linguagens"] == ["SQL", "C/C++/C#"] and first["bancos_dados"] is None
    assert rows["r9"]["genero"] == "Feminino" and rows["r9"]["linguagens"] is None
    other = rows["t1"]
    assert (other["regiao"], other["modelo_trabalho"], other["usa_ia_generativa"]) == (
        "Sudeste", "Híbrido", False)
    assert other["cloud_utilizada"] == ["AWS"] and other["salario_medio_mensal"] is None
    # Two people with the very same answers and no id both stay, with reproducible ids.
    made = sorted(key for key in rows if key.startswith("2023_"))
    again = [r["respondente_id"] for r in silver.conform(spark, f"{home}/bronze").collect()]
    assert len(made) == 2 and sorted(k for k in again if k.startswith("2023_")) == made

    written = gold.write_marts(spark, f"{home}/silver", f"{home}/gold")
    lake = Lake.from_paths(spark, f"{home}/silver", f"{home}/gold")
    for name, contract in GOLD_COLUMNS.items():
        mart = lake.mart(name)
        assert dict(mart.dtypes) == contract and mart.count() == written[name]
        assert len([f for f in os.listdir(f"{home}/gold/{name}") if f.endswith(".parquet")]) == 1

    gold.create_database(spark, "survey_test", f"{home}/catalog")
    gold.declare_silver(spark, f"{home}/silver", "survey_test")
    gold.declare_marts(spark, f"{home}/gold", "survey_test")
    assert spark.table("survey_test.silver").where("survey_year = 2023").count() == 4
    assert spark.table("survey_test.gold_evolucao_anual").count() == 2


def differing(left, right):
    """Rows that two results do not share, with doubles as text."""
    assert sorted(left.columns) == sorted(right.columns)
    rows = [sorted(str([row[c] for c in sorted(df.columns)]) for row in df.collect()) for df in (left, right)]
    return [pair for pair in zip(*rows) if pair[0] != pair[1]] or len(rows[0]) != len(rows[1])


@pytest.fixture(scope="module")
def stored(spark):
    """A lake of stored marts, and one that computes them from the same respondents."""
    home = scratch_path(spark, "stored")
    respondents(spark, SF_DIR).write.partitionBy("survey_year").parquet(f"{home}/silver")
    silver = spark.read.parquet(f"{home}/silver")
    for name in MARTS:
        gold.write_mart(build_mart(name, silver, WORDS), name, f"{home}/gold")
    return Lake.from_paths(spark, f"{home}/silver", f"{home}/gold", WORDS), Lake.over_silver(silver, WORDS)


@pytest.mark.parametrize("name", [*QUERIES, *FRAMES])
def test_queries_over_stored_marts(stored, name):
    query = {**QUERIES, **FRAMES}[name]
    assert not differing(query(stored[0]), query(stored[1]))


ORDERS = {
    "Q1.1": ["ano"], "Q1.2": [f"-resp_{2001}"], "Q1.4": ["ano", "-respondentes"], "Q2.1": ["-salario_mediano"],
    "Q3.1": ["ano", "-respondentes"], "Q4.1": ["categoria", "-pct_adocao"], "Q4.2": ["-variacao_pp"], "Q4.3": ["-salario_mediano"],
    "Q5.1": ["ano"], "Q5.2": ["-pct_uso_pessoal"], "Q5.4": ["ano", "-respondentes"], "Q6.2": ["regiao", "modelo_trabalho"],
    "Q7.1": ["-pct_buscando"], "Q7.4": ["salario_mediano"],
}


@pytest.mark.parametrize("name", list(ORDERS))
def test_order_of_queries(stored, name):
    rows = QUERIES[name](stored[0]).collect()
    keys = [
        [(-1 if c[0] == "-" else 1) * r[c.lstrip("-")] if isinstance(r[c.lstrip("-")], (int, float)) else str(r[c.lstrip("-")]) for c in ORDERS[name]]
        for r in rows
        if all(r[c.lstrip("-")] is not None for c in ORDERS[name])
    ]
    assert keys == sorted(keys)


def test_a_new_edition_moves_the_latest_one(spark, stored):
    silver = stored[1].silver
    newer = silver.where("survey_year = 1995").withColumn("survey_year", F.lit(2002))
    lake = Lake.over_silver(silver.unionByName(newer), WORDS)
    assert lake.editions == (*range(1995, 2003),) and lake.last_edition == 2002
    assert "resp_2002" in QUERIES["Q1.2"](lake).columns and "pct_2002" in QUERIES["Q4.2"](lake).columns
    assert FRAMES["K1"](lake).first()["respondentes_por_edicao"].count(",") == 7


def test_queries_leave_the_session_as_it_was(spark):
    def settings():
        return sorted((r["key"], r["value"]) for r in spark.sql("SET").collect())

    before = settings()
    QUERIES["Q2.2"](Lake.over_silver(respondents(spark, SF_DIR), WORDS)).collect()
    bronze.ingest(spark, export_raw(spark, SF_DIR), scratch_path(spark, "settings"))
    assert settings() == before


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf(dict):
        pass

    class Session:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_path(Session(**{"spark.master": master}), "x")
    assert scratch_path(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "s3a://b/c"}), "x").startswith("s3a://b/c/x-")


def test_jobs_do_not_grow_with_the_exports(spark):
    home = scratch_path(spark, "many")
    os.makedirs(f"{home}/raw")

    def jobs(n):
        for i in range(n):
            with open(f"{home}/raw/s{i}_2024.csv", "w", encoding="utf-8") as out:
                out.write('"0.a_\ntoken",1.a_idade,1.a_idade\nr1,20,21\n')
        tracker, group = spark.sparkContext.statusTracker(), f"headers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        groups = bronze.group_exports(spark, bronze.list_csv_files(spark, f"{home}/raw"))
        assert len(groups) == 1 and groups[0].columns == ["0.a_\ntoken", "1.a_idade", "1.a_idade"]
        return len(tracker.getJobIdsForGroup(group))

    assert jobs(2) == jobs(40) == 0


def test_rerun_replaces_only_its_editions(spark, home):
    os.makedirs(f"{home}/raw2")
    with open(f"{home}/raw2/survey_2024.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([NEW[:2], ["n1", "20"], ["n2", "21"]])
    bronze.ingest(spark, f"{home}/raw2", f"{home}/bronze")
    stored = spark.read.parquet(f"{home}/bronze")
    counts = {row["survey_year"]: row["count"] for row in stored.groupBy("survey_year").count().collect()}
    assert counts == {2023: 5, 2024: 2}


def test_errors(spark, home):
    with pytest.raises(ValueError):
        bronze.edition_year("/tmp/survey_99.csv")
    os.makedirs(f"{home}/nothing")
    with pytest.raises(FileNotFoundError):
        bronze.ingest(spark, f"{home}/nothing", f"{home}/b2")
