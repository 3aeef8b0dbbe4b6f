"""The whole chain, raw export → Bronze → Silver → Gold → catalog, over the customer table.

Customers are the respondents of three editions with different header syntaxes, shifted question
codes and questions that come and go. Every query exports them as CSV into the session's shared
folder, ingests that export and reads the result back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import table, with_silver
from surveylake.functions.rules import CANONICAL_FIELDS, REGION_STATES
from surveylake.operators.harmonise import (
    header_table,
    name_headers,
    resolution_report,
    resolve_blocks,
    resolve_fields,
)
from surveylake.operators.ranking import first_of_each
from surveylake.plans.lake import Lake
from surveylake.session import scratch_path
from surveylake.sources import bronze, gold, silver
from surveylake.sources.split_csv import read_split_csv

REGISTRY = Registry()
entry = REGISTRY.entry

STATES = ["ac", "AL", " am", "AP", "BA", "CE ", "DF", "ES", "GO", "ma", "MG", "MS", "MT", "PA", "PB",
          "PE", "PI", "pr", "RJ", "RN", "", "RS", "XX", "SC", "sp"]
JOBS = {
    "BUILDING": "Analista de Dados/Data Analyst",
    "AUTOMOBILE": "Engenheiro de Machine Learning",
    "MACHINERY": "Cientista de Dados",
    "HOUSEHOLD": "Gerente de Dados ",
    "FURNITURE": "Outra Opção",
}
LEVELS = {
    "BUILDING": "JÚNIOR",
    "AUTOMOBILE": "Pleno",
    "MACHINERY": "senior",
    "HOUSEHOLD": "Staff",
    "FURNITURE": "-",
}
GENDERS = {
    "AFRICA": "Masculino", "AMERICA": "feminino", "ASIA": "Homem", "EUROPE": "Mulher ",
    "MIDDLE EAST": "Prefiro não informar",
}
AI_USE = {
    "BUILDING": "Não utilizo nenhum tipo", "AUTOMOBILE": "Github Copilot", "MACHINERY": None,
    "HOUSEHOLD": "A empresa em que trabalho paga", "FURNITURE": "Apenas soluções gratuitas",
}
MODELS = ["Modelo 100% presencial", "Modelo híbrido com dias fixos presencial", "Modelo 100% remoto"]


def _choice(key: Column, answers: dict) -> Column:
    value = F.lit(None).cast("string")
    for name, answer in answers.items():
        value = F.when(key == name, F.lit(answer)).otherwise(value)
    return value


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with its edition and its answers under plain names."""
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    people = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    balance, nation, segment = F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_mktsegment")
    region = F.col("r_name")
    year = F.when(balance < 3000, 2023).when(balance < 6500, 2024).otherwise(2025)
    thousands = F.floor(balance / 1000).cast("int") + 1

    def option(chosen: Column) -> Column:
        """One option of a block that people of one region skipped."""
        return F.when(region != "MIDDLE EAST", chosen.cast("int").cast("string"))

    return people.select(
        year.alias("year"),
        F.when((region != "ASIA") | (year != 2023), F.concat(F.lit("r"), F.col("c_custkey")))
        .alias("id"),
        F.concat(
            (nation + 20).cast("string"), F.when(year == 2024, F.lit(".0")).otherwise(F.lit(""))
        ).alias("age"),
        _choice(region, GENDERS).alias("gender"),
        F.element_at(F.array(*[F.lit(s) for s in STATES]), nation + 1).alias("state"),
        F.when(region == "EUROPE", F.lit("Sudeste")).alias("declared"),
        _choice(segment, JOBS).alias("job"),
        _choice(segment, LEVELS).alias("level"),
        F.when(balance < 0, F.lit("não recebo remuneração"))
        .otherwise(
            F.concat(
                F.lit("de R$ "), thousands, F.lit(".001/mês a R$ "), thousands + 1,
                F.lit(".000/mês"),
            )
        )
        .alias("band"),
        F.element_at(F.array(*[F.lit(m) for m in MODELS]), nation % 3 + 1).alias("model"),
        F.lit("Modelo 100% remoto").alias("ideal_model"),
        _choice(segment, AI_USE).alias("ai"),
        F.when(nation < 8, "Sim").when(nation < 20, "Não").alias("moving"),
        F.lit(None).cast("string").alias("parent"),
        option(nation < 15).alias("sql"),
        option(nation >= 10).alias("cpp"),
        option(F.lit(False)).alias("none"),
        option(nation == 3).alias("other"),
        option(segment.isin("BUILDING", "MACHINERY")).alias("mysql"),
        option((nation >= 5) & (nation <= 20)).alias("bigquery"),
        F.concat(F.lit('disse "sim",\n'), F.col("c_name"), F.lit("\n fim")).alias("comment"),
        F.monotonically_increasing_id().cast("string").alias("index"),
    )


# Raw header of every exported answer, per edition.
HEADERS = {
    2023: {
        "index": "Unnamed: 0",
        "id": "('P0', 'id')",
        "age": "('P1_a ', 'Idade')",
        "gender": "('P1_b ', 'Genero')",
        "state": "('P1_i_1 ', 'uf onde mora')",
        "declared": "('P1_i_2 ', 'Regiao onde mora')",
        "job": "('P2_f ', 'Cargo Atual')",
        "level": "('P2_g ', 'Nivel')",
        "band": "('P2_h ', 'Faixa salarial')",
        "ideal_model": "('P2_s ', 'Qual a forma de trabalho ideal para você?')",
        "model": "('P2_r ', 'Atualmente qual a sua forma de trabalho?')",
        "parent": "('P4_d ', 'Quais das linguagens listadas abaixo você utiliza no trabalho?')",
        "sql": "('P4_d_1 ', 'SQL')",
        "cpp": "('P4_d_2 ', 'C/C++/C#')",
        "none": "('P4_d_3 ', 'Não utilizo nenhuma das linguagens listadas')",
        "other": "('P4_d_4 ', 'Outra')",
        "ai": "('P4_m ', 'Utiliza ChatGPT ou LLMs no trabalho?')",
        "comment": "('P9_z ', \"Comentário, d'opinião livre\")",
    },
    2024: {
        "id": "0.a_token",
        "age": "1.a_idade",
        "gender": "1.b_genero",
        "state": "1.i.1_uf_onde_mora",
        "declared": "1.i.2_regiao_onde_mora",
        "job": "2.f_cargo_atual",
        "level": "2.h_nivel",
        "band": "2.i_faixa_salarial",
        "model": "2.r_modelo_de_trabalho_atual",
        "ideal_model": "2.s_modelo_de_trabalho_ideal",
        "moving": "2.n_planos_de_mudar_de_emprego_6m",
        "parent": "4.d_linguagem_de_programacao_(dia_a_dia)",
        "sql": "4.d.1_SQL",
        "cpp": "4.d.2_C/C++/C#",
        "none": "4.d.3_Não utilizo nenhuma das linguagens listadas",
        "other": "4.d.4_Outra",
        "ai": "4.m_usa_chatgpt_ou_copilot_no_trabalho?",
        "comment": "9.z_comentario",
    },
    2025: {
        "comment": "Comentário",
        "id": "0.a_token",
        "age": "1.a_idade",
        "gender": "1.b_genero",
        "state": "1.i.1_uf_onde_mora",
        "declared": "1.i.2_regiao_onde_mora",
        "job": "2.f_cargo_atual",
        "level": "2.h_nivel",
        "band": "2.i_faixa_salarial",
        "ideal_model": "2.r_modelo_de_trabalho_ideal",
        "model": "2.q_modelo_de_trabalho_atual",
        "moving": "2.n_planos_de_mudar_de_emprego_6m",
        "parent": "4.d_banco_de_dados_(dia_a_dia)",
        "mysql": "4.d.1_MySQL",
        "bigquery": "4.d.2_Google BigQuery",
        "none": "4.d.3_Não utilizo nenhum dos bancos de dados listados",
        "ai": "4.m_usa_chatgpt_ou_copilot_no_trabalho?",
    },
}
COLUMNS_KEPT = {year: len(h) - ("index" in h) for year, h in HEADERS.items()}


def written_edition(people: DataFrame, year: int, raw_path: str) -> None:
    """Write one edition's export, in the place of an earlier one."""
    edition = people.where(F.col("year") == year).select(*HEADERS[year]).toDF(*HEADERS[year].values())
    writer = edition.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    writer.csv(f"{raw_path}/pesquisa_{year}_{year + 1}.csv")


def export_raw(spark: SparkSession, sf_dir: str) -> str:
    """Write the three editions as CSV exports; returns the raw folder."""
    raw_path = f"{scratch_path(spark, 'survey')}/raw"
    people = answers(spark, sf_dir)
    for year in HEADERS:
        written_edition(people, year, raw_path)
    return raw_path


def to_bronze(spark: SparkSession, sf_dir: str) -> str:
    raw_path = export_raw(spark, sf_dir)
    bronze_path = raw_path.removesuffix("raw") + "bronze"
    bronze.ingest(spark, raw_path, bronze_path)
    return bronze_path


def to_silver(spark: SparkSession, sf_dir: str) -> str:
    bronze_path = to_bronze(spark, sf_dir)
    silver_path = bronze_path.removesuffix("bronze") + "silver"
    silver.write_silver(silver.conform(spark, bronze_path), silver_path)
    return silver_path


# --- oracle pieces -----------------------------------------------------------------------------


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _case(key: str, answers: dict) -> str:
    whens = " ".join(
        f"WHEN {_q(k)} THEN {'NULL' if v is None else _q(v)}" for k, v in answers.items()
    )
    return f"CASE {key} {whens} END"


_YEAR = "CASE WHEN c_acctbal < 3000 THEN 2023 WHEN c_acctbal < 6500 THEN 2024 ELSE 2025 END"
_STATE = "CASE c_nationkey " + " ".join(
    f"WHEN {i} THEN {_q(s.strip().upper()) if s.strip() else 'NULL'}" for i, s in enumerate(STATES)
) + " END"
_REGION = "CASE " + " ".join(
    f"WHEN uf IN ({', '.join(_q(s) for s in states)}) THEN {_q(name)}"
    for name, states in REGION_STATES.items()
) + " WHEN r_name = 'EUROPE' THEN 'Sudeste' END"
_LANGUAGES = (
    "CASE WHEN survey_year < 2025 AND r_name <> 'MIDDLE EAST' THEN concat_ws(',',"
    " CASE WHEN c_nationkey >= 10 THEN 'C/C++/C#' END, CASE WHEN c_nationkey < 15 THEN 'SQL' END) END"
)
_DATABASES = (
    "CASE WHEN survey_year = 2025 AND r_name <> 'MIDDLE EAST' THEN concat_ws(',',"
    " CASE WHEN c_nationkey BETWEEN 5 AND 20 THEN 'BigQuery' END,"
    " CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'MySQL' END) END"
)
EXPECTED = f"""
base AS (SELECT *, CAST({_YEAR} AS INTEGER) AS survey_year, {_STATE} AS uf,
                CAST(floor(c_acctbal / 1000) AS INTEGER) + 1 AS k
         FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey),
expected AS (
  SELECT survey_year,
    CASE WHEN r_name <> 'ASIA' OR survey_year <> 2023 THEN 'r' || c_custkey END AS respondente_id,
    CAST(c_nationkey + 20 AS INTEGER) AS idade,
    CASE r_name WHEN 'AFRICA' THEN 'Masculino' WHEN 'ASIA' THEN 'Masculino'
      WHEN 'AMERICA' THEN 'Feminino' WHEN 'EUROPE' THEN 'Feminino'
      ELSE 'Outro / Não informado' END AS genero,
    uf AS uf_residencia, {_REGION} AS regiao,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Analista de Dados'
      WHEN 'AUTOMOBILE' THEN 'ML Engineer / MLOps' WHEN 'MACHINERY' THEN 'Cientista de Dados'
      WHEN 'HOUSEHOLD' THEN 'Gerente de Dados' ELSE 'Outros' END AS cargo,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Júnior' WHEN 'AUTOMOBILE' THEN 'Pleno'
      WHEN 'MACHINERY' THEN 'Sênior' WHEN 'HOUSEHOLD' THEN 'Especialista/Staff+' END AS senioridade,
    CASE WHEN c_acctbal >= 0 THEN (k * 1000 + 1 + (k + 1) * 1000) / 2.0::DOUBLE END
      AS salario_medio_mensal,
    CASE c_nationkey % 3 WHEN 0 THEN 'Presencial' WHEN 1 THEN 'Híbrido' ELSE 'Remoto' END
      AS modelo_trabalho,
    CASE WHEN survey_year > 2023 THEN CASE WHEN c_nationkey < 8 THEN true
      WHEN c_nationkey < 20 THEN false END END AS busca_nova_oportunidade,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'Não utiliza'
      WHEN 'AUTOMOBILE' THEN 'Ferramentas de código (Copilot)'
      WHEN 'HOUSEHOLD' THEN 'Paga — custeada pela empresa'
      WHEN 'FURNITURE' THEN 'Apenas soluções gratuitas' END AS tipo_uso_ia,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment <> 'BUILDING' END AS usa_ia_generativa,
    {_LANGUAGES} AS linguagens, {_DATABASES} AS bancos_dados
  FROM base)"""

_SHOWN = [
    "survey_year", "idade", "genero", "uf_residencia", "regiao", "cargo", "senioridade",
    "salario_medio_mensal", "modelo_trabalho", "busca_nova_oportunidade", "tipo_uso_ia",
    "usa_ia_generativa",
]


def _expected(select: str) -> str:
    return f"WITH {EXPECTED}\n{select}"


def _shown(people: DataFrame) -> DataFrame:
    """The compared columns; lists as sorted text, generated ids as NULL."""
    given = F.col("respondente_id")
    lists = [
        F.array_join(F.array_sort(name), ",").alias(name) for name in ("linguagens", "bancos_dados")
    ]
    return people.select(
        F.when(given.startswith("r"), given).alias("respondente_id"), *_SHOWN, *lists
    )


# --- Bronze ------------------------------------------------------------------------------------------


@entry("S1_S4", _expected("""
SELECT survey_year, 'pesquisa_' || survey_year || '_' || (survey_year + 1) || '.csv' AS arquivo_origem,
  count(*) AS linhas, count(*) AS ingeridas FROM base GROUP BY survey_year"""))
def s1_s4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List, date, read and write the exports; lineage of what arrived in Bronze (with S2, H8)."""
    everything = spark.read.parquet(to_bronze(spark, sf_dir))
    return everything.groupBy("survey_year", "arquivo_origem").agg(
        F.count(F.lit(1)).alias("linhas"), F.count("ingerido_em").alias("ingeridas")
    )


_COMMENTS = _expected("""
SELECT survey_year, 'disse "sim",' || chr(10) || c_name || chr(10) || ' fim' AS comentario FROM base""")


def _comments(spark: SparkSession, sf_dir: str, read: Callable[[str, int], DataFrame]) -> DataFrame:
    raw_path = export_raw(spark, sf_dir)
    parts = []
    for path in bronze.list_csv_files(spark, raw_path):
        year = bronze.edition_year(path)
        position = list(HEADERS[year]).index("comment")
        comment = F.col(f"c{position}").alias("comentario")
        parts.append(read(path, len(HEADERS[year])).select(F.lit(year).alias("survey_year"), comment))
    return reduce(DataFrame.unionByName, parts)


@entry("S3", _COMMENTS)
def s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted answers with line breaks, quotes and commas come back whole."""
    return _comments(spark, sf_dir, lambda path, n: bronze.read_survey_csv(spark, [path], columns=n))


@entry("S3_split", _COMMENTS)
def s3_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answers where records are cut in byte ranges, so that a file has many tasks."""
    return _comments(spark, sf_dir, lambda path, n: read_split_csv(spark, [path], n))


@entry("H6_file", """
SELECT c_custkey AS chave, CAST(c_nationkey + 20 AS VARCHAR) AS idade, c_mktsegment AS segunda FROM customer""")
def h6_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export whose header names one column twice: both keep their answers."""
    raw_path = f"{scratch_path(spark, 'survey')}/raw"
    line = F.concat_ws(",", F.concat(F.lit("r"), "c_custkey"), F.col("c_nationkey") + 20, "c_mktsegment")
    first_of_file = F.monotonically_increasing_id().bitwiseAND(2**33 - 1) == 0
    header = F.when(first_of_file, F.array(F.lit("0.a_token,1.a_idade,1.a_idade"))).otherwise(F.array().cast("array<string>"))
    lines = table(spark, sf_dir, "customer").select(F.explode(F.concat(header, F.array(line))))
    lines.write.text(f"{raw_path}/pesquisa_2024.csv")
    (edition,) = bronze.bronze_frames(spark, bronze.list_csv_files(spark, raw_path)).values()
    key = F.substring("p0_a_token", 2, 20).cast("bigint").alias("chave")
    return edition.select(key, F.col("p1_a_idade").alias("idade"), F.col("p1_a_idade_2").alias("segunda"))


@entry("S5_S6", _expected("""
SELECT survey_year, CAST(CASE survey_year """ + " ".join(
    f"WHEN {year} THEN {count}" for year, count in COLUMNS_KEPT.items()) + """ END AS INTEGER) AS colunas,
  count(*) AS linhas FROM base GROUP BY survey_year"""))
def s5_s6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions found from the partitions, each read with its own columns."""
    bronze_path = to_bronze(spark, sf_dir)
    parts = []
    for year in bronze.bronze_editions(spark, bronze_path):
        edition = bronze.read_edition(spark, bronze_path, year)
        own = [c for c in edition.columns if c not in bronze.LINEAGE]
        parts.append(
            edition.groupBy().agg(
                F.lit(year).alias("survey_year"), F.lit(len(own)).alias("colunas"),
                F.count(F.lit(1)).alias("linhas"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# --- resolution -----------------------------------------------------------------------------------------


def _named(spark: SparkSession) -> DataFrame:
    headers = {str(year): list(h.values()) for year, h in HEADERS.items()}
    return name_headers(header_table(spark, headers))


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(edition, name, answered) for every exported column, in one pass over the answers."""
    people = answers(spark, sf_dir)
    names = _named(spark).where(~F.col("junk")).select("edition", "raw", "name")
    counted = people.groupBy("year").agg(
        *[F.count(c).alias(c) for c in people.columns if c != "year"]
    )
    pairs = F.explode(
        F.create_map(
            *[p for c in people.columns if c != "year" for p in (F.lit(c), F.col(c))]
        )
    ).alias("answer", "respostas")
    long = counted.select(F.col("year").cast("string").alias("edition"), pairs)
    exported = spark.createDataFrame(
        [(str(y), answer, raw) for y, h in HEADERS.items() for answer, raw in h.items()],
        "edition string, answer string, raw string",
    )
    return long.join(exported, ["edition", "answer"]).join(names, ["edition", "raw"]).select(
        "edition", "name", "respostas"
    )


_FIELD_OF = {
    "respondente_id": "id", "idade": "age", "genero": "gender", "uf_residencia": "state",
    "regiao_declarada": "declared", "cargo": "job", "senioridade": "level",
    "faixa_salarial": "band", "modelo_trabalho": "model", "busca_nova_oportunidade": "moving",
    "tipo_uso_ia": "ai",
}
_NAME_OF = {
    2023: {"id": "p0_id", "age": "p1_a_idade", "gender": "p1_b_genero",
           "state": "p1_i_1_uf_onde_mora", "declared": "p1_i_2_regiao_onde_mora",
           "job": "p2_f_cargo_atual", "level": "p2_g_nivel", "band": "p2_h_faixa_salarial",
           "model": "p2_r_atualmente_qual_a_sua_forma_de_trabalho",
           "ai": "p4_m_utiliza_chatgpt_ou_llms_no_trabalho"},
    2024: {"id": "p0_a_token", "age": "p1_a_idade", "gender": "p1_b_genero",
           "state": "p1_i_1_uf_onde_mora", "declared": "p1_i_2_regiao_onde_mora",
           "job": "p2_f_cargo_atual", "level": "p2_h_nivel", "band": "p2_i_faixa_salarial",
           "model": "p2_r_modelo_de_trabalho_atual", "moving": "p2_n_planos_de_mudar_de_emprego_6m",
           "ai": "p4_m_usa_chatgpt_ou_copilot_no_trabalho"},
}
_NAME_OF[2025] = {**_NAME_OF[2024], "model": "p2_q_modelo_de_trabalho_atual"}

_FILLED_SQL = {
    "id": "CASE WHEN r_name <> 'ASIA' OR survey_year <> 2023 THEN 1 END", "age": "1", "gender": "1",
    "state": "1", "declared": "CASE WHEN r_name = 'EUROPE' THEN 1 END", "job": "1", "level": "1",
    "band": "1", "model": "1", "moving": "CASE WHEN c_nationkey < 20 THEN 1 END",
    "ai": "CASE WHEN c_mktsegment <> 'MACHINERY' THEN 1 END",
}


def _resolution_sql() -> str:
    rows = []
    for year, names in _NAME_OF.items():
        for field_spec in CANONICAL_FIELDS:
            answer = _FIELD_OF.get(field_spec.name)
            name = names.get(answer) if answer else None
            if name:
                rows.append(
                    f"SELECT '{year}' AS edition, '{field_spec.name}' AS field, '{name}' AS name,"
                    f" 'resolvido' AS status, count({_FILLED_SQL[answer]}) AS respostas"
                    f" FROM base WHERE survey_year = {year}"
                )
            else:
                rows.append(
                    f"SELECT '{year}', '{field_spec.name}', NULL, 'ausente', NULL"
                )
    return _expected("\nUNION ALL ".join(rows))


@entry("H9_H17", _resolution_sql())
def h9_h17(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved and absent fields of every edition, with the answers in the resolved column."""
    named = _named(spark)
    report = resolution_report(named, resolve_fields(named))
    return report.join(_filled(spark, sf_dir), ["edition", "name"], "left")


_BLOCK_ROWS = {
    (2023, "linguagens"): [("p4_d_1_sql", "SQL", True), ("p4_d_2_c_c_mais_mais_c", "C/C++/C#", True),
        ("p4_d_3_nao_utilizo_nenhuma_das_linguagens_listadas", None, False),
        ("p4_d_4_outra", None, False)],
    (2025, "bancos_dados"): [("p4_d_1_mysql", "MySQL", True),
        ("p4_d_2_google_bigquery", "BigQuery", True),
        ("p4_d_3_nao_utilizo_nenhum_dos_bancos_de_dados_listados", None, False)],
}
_BLOCK_ROWS[(2024, "linguagens")] = _BLOCK_ROWS[(2023, "linguagens")]


def _block_sql() -> str:
    return _expected("\nUNION ALL ".join(
        f"SELECT '{year}' AS edition, '{block}' AS block, '{name}' AS name,"
        f" {_q(label) if label else 'NULL'} AS label, {str(item).lower()} AS technology,"
        f" count(CASE WHEN r_name <> 'MIDDLE EAST' THEN 1 END) AS respostas"
        f" FROM base WHERE survey_year = {year}"
        for (year, block), rows in _BLOCK_ROWS.items() for name, label, item in rows
    ))


@entry("H10_H12", _block_sql())
def h10_h12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options of the multi-select blocks: items with their label, non-answers without."""
    blocks = resolve_blocks(_named(spark))
    kept = blocks.withColumn("label", F.when(F.col("technology"), F.col("label")))
    return kept.join(_filled(spark, sf_dir), ["edition", "name"])


# --- Silver ------------------------------------------------------------------------------------------------


@entry("H13_H18", _expected(
    f"SELECT respondente_id, {', '.join(_SHOWN)}, linguagens, bancos_dados FROM expected"))
def h13_h18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every respondent in the canonical schema (H13, H14, H15, H18, X1–X12 on the way)."""
    return _shown(spark.read.parquet(to_silver(spark, sf_dir)))


@entry("H14", with_silver("""
SELECT CAST(survey_year AS INTEGER) AS survey_year, cargo, NULL::VARCHAR AS regiao,
  salario_medio_mensal FROM silver WHERE survey_year % 2 = 0
UNION ALL SELECT survey_year, NULL, regiao, NULL FROM silver WHERE survey_year % 2 = 1"""))
def h14(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even and odd editions with different columns, aligned to one list of columns and types."""
    from surveylake.bindings.tables import respondents

    people = respondents(spark, sf_dir)
    even = people.where(F.col("survey_year") % 2 == 0)
    odd = people.where(F.col("survey_year") % 2 == 1)
    parts = silver.align(
        [
            even.select("survey_year", "cargo", "salario_medio_mensal"),
            odd.select("regiao", F.col("survey_year").cast("string").alias("survey_year")),
        ]
    )
    return reduce(DataFrame.unionByName, parts)


_LINE = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@entry("H16", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
               ORDER BY {', '.join(_LINE)}) AS k FROM lineitem)
WHERE k = 1""")
def h16(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number), the first in the order of all other columns."""
    lines = table(spark, sf_dir, "lineitem")
    kept = first_of_each(lines, ["l_orderkey", "l_linenumber"], [F.col(c) for c in _LINE])
    return kept.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )


@entry("X10", _expected("""
SELECT survey_year, count(*) AS linhas, count(*) AS ids,
  count(CASE WHEN respondente_id IS NULL THEN 1 END) AS gerados FROM expected GROUP BY survey_year"""))
def x10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated ids: as many distinct ids as respondents, so nobody is dropped as a repeat."""
    people = spark.read.parquet(to_silver(spark, sf_dir))
    per_id = people.groupBy("survey_year", "respondente_id").agg(F.count(F.lit(1)).alias("n"))
    made = ~F.col("respondente_id").startswith("r")
    return per_id.groupBy("survey_year").agg(
        F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("ids"),
        F.sum(F.when(made, F.col("n")).otherwise(0)).alias("gerados"),
    )


@entry("S7_S12", _expected(
    "SELECT survey_year, count(*) AS linhas FROM expected GROUP BY survey_year"))
def s7_s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondent table written by edition and read back, with its volume."""
    return silver.volume(spark.read.parquet(to_silver(spark, sf_dir)))


# --- Gold and catalog -----------------------------------------------------------------------------------------

_TECHNOLOGIES = """
SELECT i.survey_year, i.categoria, i.tecnologia, i.usuarios, b.n AS base_respondentes,
  round(i.usuarios * 100.0 / b.n, 2) AS pct_adocao
FROM (SELECT survey_year, categoria, tecnologia, count(*) AS usuarios
      FROM (SELECT survey_year, 'Linguagem' AS categoria,
                   unnest(string_split(nullif(linguagens, ''), ',')) AS tecnologia FROM expected
            UNION ALL SELECT survey_year, 'Banco de dados',
                   unnest(string_split(nullif(bancos_dados, ''), ',')) FROM expected)
      GROUP BY ALL) i
JOIN (SELECT survey_year, count(*) AS n FROM expected
      WHERE linguagens IS NOT NULL OR bancos_dados IS NOT NULL GROUP BY survey_year) b
  ON i.survey_year = b.survey_year"""


@entry("S8_S9", _expected(_TECHNOLOGIES))
def s8_s9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts written from the respondent table; the technology mart read back."""
    silver_path = to_silver(spark, sf_dir)
    gold_path = silver_path.removesuffix("silver") + "gold"
    gold.write_marts(spark, silver_path, gold_path)
    return Lake.from_paths(spark, silver_path, gold_path).mart("gold_tecnologias")


@entry("S10", _expected("""
SELECT survey_year, cargo, count(*) AS linhas FROM expected GROUP BY survey_year, cargo"""))
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondent table declared in the catalog and queried by name."""
    silver_path = to_silver(spark, sf_dir)
    home = silver_path.removesuffix("/silver")
    database = "survey_" + home.rsplit("-", 1)[-1]
    gold.create_database(spark, database, f"{home}/catalog")
    gold.declare_silver(spark, silver_path, database)
    return spark.sql(
        f"SELECT survey_year, cargo, count(*) AS linhas FROM `{database}`.silver"
        " GROUP BY survey_year, cargo"
    )


@entry("S11", """
SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment, o_orderstatus""")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet folders as views, joined in SQL."""
    names = {f"s11_{name}": f"{sf_dir}/{name}.parquet" for name in ("orders", "customer")}
    gold.register_views(spark, names)
    return spark.sql(
        "SELECT c_mktsegment, o_orderstatus, count(*) AS n FROM s11_orders"
        " JOIN s11_customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus"
    )
