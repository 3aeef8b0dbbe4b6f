"""Answer expressions over the tables: cleaning, labels, bands, yes/no, regions, blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import WORDS, respondents, table, with_silver
from surveylake.functions import rules
from surveylake.functions import text as X
from surveylake.operators.compare import relative_to

REGISTRY = Registry()
entry = REGISTRY.entry


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Each customer gives the survey answer its nation stands for. The list is cycled by nation key.
def _answer_sql(answers: Sequence[str]) -> str:
    """CASE over the nation key; valid in Spark and in the oracle."""
    whens = "".join(f" WHEN {i} THEN {_quoted(a)}" for i, a in enumerate(answers))
    return f"CASE c_nationkey % {len(answers)}{whens} END"


def _answers(spark: SparkSession, sf_dir: str, answers: Sequence[str]) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", F.expr(_answer_sql(answers)).alias("resposta"))


_TRIM = "trim(resposta, chr(160) || chr(9) || chr(10) || chr(13) || ' ')"
_CLEAN = f"CASE WHEN lower({_TRIM}) NOT IN ('', 'nan', 'none', 'null', '-') THEN {_TRIM} END"


def _cleaned(answers: Sequence[str]) -> str:
    return (
        "(SELECT c_custkey, limpa, lower(strip_accents(limpa)) AS dobrada FROM (SELECT c_custkey,"
        f" {_CLEAN} AS limpa FROM (SELECT c_custkey, {_answer_sql(answers)} AS resposta"
        " FROM customer)))"
    )


# --- cleaning ------------------------------------------------------------------------------

_DIRTY = (
    "CASE c_nationkey WHEN 0 THEN '' WHEN 1 THEN ' NaN ' WHEN 2 THEN '-' WHEN 3 THEN 'NULL'"
    " WHEN 4 THEN '   ' WHEN 5 THEN 'None' WHEN 6 THEN chr(160) || c_mktsegment || ' '"
    " WHEN 7 THEN chr(9) || c_mktsegment || chr(10) ELSE '  ' || c_mktsegment || '  ' END"
)


@entry("X1", f"""
SELECT c_custkey, {_CLEAN} AS limpa
FROM (SELECT c_custkey, {_DIRTY} AS resposta FROM customer)""")
def x1(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", X.clean_text(F.expr(_DIRTY)).alias("limpa"))


# --- labels ----------------------------------------------------------------------------------

_TEXT_RULES = [
    (r" the [^\n]* of ", "english"),
    (r" (le|la|les) ", "french"),
    (r" (der|die|das) ", "german"),
    (r" (el|los|las) ", "spanish"),
]


def _case(rule_list: Sequence[tuple[str, str]], folded: str, cleaned: str) -> str:
    whens = "".join(
        f" WHEN regexp_matches({folded}, {_quoted(pattern)}, 's') THEN {_quoted(label)}"
        if "(?s)" in pattern
        else f" WHEN regexp_matches({folded}, {_quoted(pattern)}) THEN {_quoted(label)}"
        for pattern, label in rule_list
    )
    return f"CASE WHEN {cleaned} IS NULL THEN NULL{whens} ELSE {cleaned} END"


@entry("X2", f"""
SELECT doc_id, lang, md5({_case(_TEXT_RULES, 'f', 't')}) AS rotulo
FROM (SELECT doc_id, lang, t, lower(strip_accents(t)) AS f
      FROM (SELECT doc_id, lang, trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(160))
                     AS t FROM documents))""")
def x2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through an ordered rule list; the text is folded once."""
    documents = table(spark, sf_dir, "documents")
    cleaned = documents.withColumn("_clean", X.clean_text(F.col("text")))
    folded = cleaned.withColumn("_folded", X.fold(F.col("_clean")))
    label = X.label_by_rules(F.col("_clean"), _TEXT_RULES, F.col("_folded"))
    return folded.select("doc_id", "lang", F.md5(label).alias("rotulo"))


_LABEL_ANSWERS = {
    "X2a": (
        X.seniority_label, rules.SENIORITY_RULES,
        ["Júnior", "JUNIOR", "júnior ", "Pleno", "Sênior", "senior", "Especialista", "Staff Engineer",
         "Estágiário", "estagio", "Trainee", "Diretor ", "nan", "", "Gerente"],
    ),
    "X2b": (
        X.work_model_label, rules.WORK_MODEL_RULES,
        ["Modelo 100% presencial", "Modelo híbrido flexível", "Modelo 100% remoto",
         "Modelo híbrido com dias fixos de trabalho presencial", "Remoto (em qualquer lugar)",
         "Totalmente  remoto", "HIBRIDO", "Nômade", "-", "100%  Remoto"],
    ),
    "X2c": (
        X.job_label, rules.JOB_RULES,
        ["Analista de Dados/Data Analyst", "Cientista de Dados/Data Scientist",
         "Engenheiro de Dados/Data Engineer", "Analista de BI/BI Analyst",
         "Engenheiro de Machine Learning/ML Engineer", "Analytics Engineer",
         "Gerente/Coordenador de Dados", "Product Manager", "Analista de Negócios",
         "Desenvolvedor", "Estatístico", "Economista", "Professor", "DBA/Administrador de Banco",
         "Outra Opção", "Data Architect", "none", "DATA SCIENTIST"],
    ),
    "X2d": (
        X.gender_label, rules.GENDER_RULES,
        ["Masculino", "Feminino ", "Homem cis", "MULHER", "Prefiro não informar", "Não binário",
         "Outro", "Agênero", "", "feminino"],
    ),
    "X2e": (
        X.ai_usage_label, rules.AI_USAGE_RULES,
        ["Não utilizo nenhum tipo de solução de AI",
         "Utilizo apenas soluções gratuitas, A empresa em que trabalho paga pelas soluções",
         "Eu pago do meu próprio bolso", "Utilizo soluções do tipo Copilot", "Github Copilot, Cursor",
         "Utilizo apenas soluções gratuitas", "AI para código", "Outra forma", "null"],
    ),
    "X2f": (
        X.ai_priority_label, rules.AI_PRIORITY_RULES,
        ["Sim, é nossa principal prioridade", "Sim, é uma das principais prioridades",
         "Mais ou menos, temos iniciativas isoladas", "Não é uma iniciativa em que investimos",
         "Não sei opinar.", "SIM", "Talvez", "-"],
    ),
    "X2g": (
        X.ai_result_label, rules.AI_RESULT_RULES,
        ["Sim, temos casos em produção", "Em partes, temos pilotos", "Ainda não começamos",
         "Estamos em fase de investigação", "Não sei opinar", "Piloto", "Outro", ""],
    ),
}


def _register_labels() -> None:
    for name, (label, rule_list, answers) in _LABEL_ANSWERS.items():
        def query(spark: SparkSession, sf_dir: str, label=label, answers=answers) -> DataFrame:
            cleaned = _answers(spark, sf_dir, answers).withColumn(
                "_clean", X.clean_text(F.col("resposta"))
            )
            folded = cleaned.withColumn("_folded", X.fold(F.col("_clean")))
            return folded.select(
                "c_custkey", label(F.col("_clean"), F.col("_folded")).alias("rotulo")
            )

        REGISTRY.add(
            name, query,
            f"SELECT c_custkey, {_case(rule_list, 'dobrada', 'limpa')} AS rotulo"
            f" FROM {_cleaned(answers)}",
        )


_register_labels()

# --- salary bands ------------------------------------------------------------------------------

# Thousands of the price, rendered in the wording of a band by the order's priority.
_K = "CAST(floor(o_totalprice / 1000) AS BIGINT)"
_BAND = (
    "CASE o_orderpriority"
    f" WHEN '1-URGENT' THEN 'Menos de R$ ' || CAST({_K} + 1 AS VARCHAR(9)) || '.000/mês'"
    f" WHEN '2-HIGH' THEN 'Acima de R$ ' || CAST({_K} AS VARCHAR(9)) || '.001/mês'"
    f" WHEN '3-MEDIUM' THEN 'de R$ ' || CAST({_K} AS VARCHAR(9)) || '.001/mês a R$ '"
    f" || CAST({_K} + 1 AS VARCHAR(9)) || '.000,50/mês'"
    " WHEN '4-NOT SPECIFIED' THEN CASE o_orderstatus WHEN 'P' THEN 'Não recebo nenhum valor'"
    " ELSE 'nenhuma faixa' END"
    f" ELSE 'R$ ' || CAST({_K} * 1000 AS VARCHAR(12)) || ' por mês, 12 vezes' END"
)


@entry("X3", f"""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN ({_K} + 1) * 1000 * 0.5
  WHEN '2-HIGH' THEN ({_K} * 1000 + 1) * 1.25
  WHEN '3-MEDIUM' THEN (({_K} * 1000 + 1) + (({_K} + 1) * 1000 + 0.5)) / 2
  WHEN '4-NOT SPECIFIED' THEN NULL ELSE {_K} * 1000 END::DOUBLE AS ponto_medio
FROM orders""")
def x3(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands = table(spark, sf_dir, "orders").select(
        "o_orderkey", X.clean_text(F.expr(_BAND)).alias("_band")
    )
    folded = bands.withColumn("_folded", X.fold(F.col("_band")))
    return folded.select(
        "o_orderkey", X.salary_midpoint(F.col("_band"), F.col("_folded")).alias("ponto_medio")
    )


# --- yes / no, AI flags ---------------------------------------------------------------------------

_YES_NO = ["1", "1.0", "TRUE", "Sim", "sim, às vezes", "yes", "S", "Verdadeiro", "0", "0.0", "false",
           "Não", "nao", "NO", "n", "Falso", "não sei", "nao sei informar", "nunca", "talvez", "nan",
           "", " null ", "-", "estou buscando"]
_USES = _LABEL_ANSWERS["X2e"][2]
_PRIORITY = _LABEL_ANSWERS["X2f"][2]


@entry("X4", f"""
SELECT c_custkey, CASE
  WHEN dobrada IN ('1', '1.0', 'true', 'sim', 'yes', 's', 'verdadeiro') THEN true
  WHEN dobrada LIKE 'sim%' THEN true
  WHEN dobrada IN ('0', '0.0', 'false', 'falso') THEN false
  WHEN dobrada LIKE 'nao sei%' THEN NULL
  WHEN dobrada LIKE 'n%' THEN false END AS valor
FROM {_cleaned(_YES_NO)}""")
def x4(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _answers(spark, sf_dir, _YES_NO)
    return answers.select("c_custkey", X.yes_no(X.clean_text(F.col("resposta"))).alias("valor"))


@entry("X5", f"""
SELECT c_custkey, CASE WHEN limpa IS NOT NULL
  THEN NOT regexp_matches(dobrada, 'nao\\s+utilizo\\s+nenhum') END AS usa_ia
FROM {_cleaned(_USES)}""")
def x5(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _answers(spark, sf_dir, _USES)
    return answers.select("c_custkey", X.uses_ai(X.clean_text(F.col("resposta"))).alias("usa_ia"))


@entry("X6", f"""
SELECT c_custkey, CASE WHEN limpa IS NULL OR dobrada LIKE 'nao sei opinar%' THEN NULL
  ELSE dobrada LIKE 'sim%' END AS prioriza
FROM {_cleaned(_PRIORITY)}""")
def x6(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = _answers(spark, sf_dir, _PRIORITY)
    flag = X.company_prioritises_ai(X.clean_text(F.col("resposta")))
    return answers.select("c_custkey", flag.alias("prioriza"))


# --- regions, codes, ages ----------------------------------------------------------------------------

_STATES = ["ac", "AL", " am", "AP", "BA", "CE ", "DF", "ES", "GO", "ma", "MG", "MS", "MT", "PA", "PB",
           "PE", "PI", "pr", "RJ", "RN", "", "RS", "XX", "SC", "sp"]
_REGION_SQL = "CASE " + " ".join(
    f"WHEN uf IN ({', '.join(_quoted(s) for s in states)}) THEN {_quoted(name)}"
    for name, states in rules.REGION_STATES.items()
) + " ELSE r_name END"


@entry("X7", f"""
SELECT c_custkey, uf, {_REGION_SQL} AS regiao
FROM (SELECT c_custkey, nullif(upper(trim({_answer_sql(_STATES)})), '') AS uf,
             CASE WHEN r_name <> 'ASIA' THEN r_name END AS r_name
      FROM customer JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey)""")
def x7(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )
    state = X.state_code(X.clean_text(F.expr(_answer_sql(_STATES))))
    declared = F.when(F.col("r_name") != "ASIA", F.col("r_name"))
    return joined.select("c_custkey", state.alias("uf"), declared.alias("_declared")).select(
        "c_custkey", "uf", X.region_of_state(F.col("uf"), F.col("_declared")).alias("regiao")
    )


@entry("X8", f"""
SELECT c_custkey, nullif(upper(trim({_answer_sql(_STATES)})), '') AS uf FROM customer""")
def x8(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    state = X.state_code(X.clean_text(F.expr(_answer_sql(_STATES))))
    return customers.select("c_custkey", state.alias("uf"))


_AGE = (
    "CASE c_nationkey WHEN 0 THEN 'vinte' WHEN 1 THEN '' WHEN 2 THEN '3,5' WHEN 3 THEN '99999999999'"
    " WHEN 4 THEN CAST(c_nationkey + 20 AS VARCHAR(9)) || '.0'"
    " WHEN 5 THEN ' ' || CAST(c_nationkey + 20 AS VARCHAR(9)) || ' '"
    " ELSE CAST(c_nationkey + 20 AS VARCHAR(9)) END"
)


@entry("X9", f"""
SELECT c_custkey, TRY_CAST(TRY_CAST(trim({_AGE}) AS DOUBLE) AS INTEGER) AS idade FROM customer""")
def x9(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select("c_custkey", X.age_in_years(F.expr(_AGE)).alias("idade"))


# --- multi-select blocks -----------------------------------------------------------------------------

_TYPES = {"ECONOMY": "Economy", "LARGE": "Large", "MEDIUM": "Medium", "PROMO": "Promo",
          "SMALL": "Small"}


def _one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order one 0/1 text column per part type; NULL where the order has no lines.

    ``STANDARD`` plays the "none of these" option: it answers the block and names nothing.
    """
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    options = [*_TYPES, "STANDARD"]
    flags = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(*[F.max((F.col("p_type") == o).cast("int")).cast("string").alias(o) for o in options])
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return orders.join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")


@entry("X11", f"""
SELECT o_orderkey, CASE WHEN l_orderkey IS NOT NULL THEN coalesce(rotulos, '') END AS rotulos
FROM orders LEFT JOIN (
  SELECT l_orderkey, string_agg(DISTINCT
    CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items())} END, ','
    ORDER BY CASE p_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _TYPES.items())} END)
    AS rotulos
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def x11(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = [F.col(option) for option in (*_TYPES, "STANDARD")]
    labels = X.chosen_labels([(F.col(option), label) for option, label in _TYPES.items()], asked)
    return _one_hot(spark, sf_dir).select(
        "o_orderkey", F.array_join(F.array_sort(labels), ",").alias("rotulos")
    )


@entry("X12", """
SELECT o_orderkey, l_orderkey IS NOT NULL AS respondeu
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey)
  ON o_orderkey = l_orderkey""")
def x12(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = [F.col(option) for option in (*_TYPES, "STANDARD")]
    return _one_hot(spark, sf_dir).select("o_orderkey", X.answered(asked).alias("respondeu"))


# --- small expressions over the respondent table --------------------------------------------------------


@entry("X13", with_silver("""
SELECT respondente_id, CASE WHEN lower(setor_empresa) LIKE '%build%'
  OR lower(setor_empresa) LIKE '%auto%' THEN 'CONSTRUCTION' ELSE 'OTHER' END AS grupo FROM silver"""))
def x13(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = X.sector_group(
        F.col("setor_empresa"), WORDS.sector_words, WORDS.sector_name, WORDS.other_sectors
    )
    return respondents(spark, sf_dir).select("respondente_id", group.alias("grupo"))


@entry("X14", with_silver("""
SELECT respondente_id, CASE senioridade WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
  WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END AS ordem FROM silver"""))
def x14(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = X.ordinal_of(F.col("senioridade"), WORDS.seniority_order)
    return respondents(spark, sf_dir).select("respondente_id", order.alias("ordem"))


@entry("X15", """
SELECT l_returnflag, l_linestatus, l_linenumber,
  round(sum(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) * 100.0
        / nullif(sum(CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END), 0), 2) AS pct,
  round((count(*) - 100) * 100.0 / 100, 2) AS dif_pct, round(count(*) / 100, 2) AS razao
FROM lineitem GROUP BY ALL""")
def x15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero denominator gives NULL."""
    def lines(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    n = F.count(F.lit(1)).cast("double")
    hundred = F.lit(100.0)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        X.percentage(lines(F.col("l_quantity") > 49), lines(F.col("l_linenumber") > 3)).alias("pct"),
        relative_to(n, hundred).alias("dif_pct"),
        relative_to(n, hundred, "ratio").alias("razao"),
    )


@entry("X16", with_silver("""
SELECT nivel_ensino, senioridade, count(*) AS n, count(*) >= 120 AS suficiente
FROM silver GROUP BY nivel_ensino, senioridade"""))
def x16(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = respondents(spark, sf_dir).groupBy("nivel_ensino", "senioridade").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.withColumn("suficiente", X.enough(F.col("n"), 120))


@entry("X17", with_silver("""
SELECT respondente_id, CAST(modelo_trabalho = 'R' AS INTEGER) AS remoto,
  CASE WHEN modelo_trabalho = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE AS remoto_ou_zero FROM silver"""))
def x17(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = F.col("modelo_trabalho") == WORDS.remote
    return respondents(spark, sf_dir).select(
        "respondente_id", X.marked(remote).alias("remoto"),
        X.marked_or_zero(remote).alias("remoto_ou_zero"),
    )


@entry("X18", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-'
  || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS edicao FROM orders""")
def x18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.edition_label(F.year("o_orderdate")).alias("edicao")
    )
