"""Each aggregation, window, ordering, set and quality operator on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import WORDS, lake, respondents, table, with_silver
from surveylake.functions import text as X
from surveylake.functions.rules import GOLD_COLUMNS, SILVER_COLUMNS
from surveylake.operators import compare, quality, segments
from surveylake.plans.analytics import QUERIES

REGISTRY = Registry()
entry = REGISTRY.entry

SALARY = "salario_medio_mensal"


def _count() -> Column:
    return F.count(F.lit(1))


def by_year(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """Respondents per (year, keys)."""
    return respondents(spark, sf_dir).groupBy("survey_year", *keys).agg(_count().alias("n"))


# --- aggregations ------------------------------------------------------------------------


@entry("A1", with_silver("""
SELECT survey_year, regiao, cargo, count(*) AS respondentes,
  round(avg(salario_medio_mensal), 2) AS salario_medio,
  quantile_disc(salario_medio_mensal, 0.5) AS salario_mediano,
  quantile_disc(salario_medio_mensal, 0.25) AS salario_p25,
  quantile_disc(salario_medio_mensal, 0.75) AS salario_p75,
  count(*) >= 30 AS amostra_suficiente
FROM silver WHERE salario_medio_mensal IS NOT NULL GROUP BY survey_year, regiao, cargo"""))
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_stats(
        respondents(spark, sf_dir), ["survey_year", "regiao", "cargo"], SALARY
    )


@entry("A1_exact", with_silver("""
SELECT survey_year, senioridade, count(*) AS respondentes,
  round(avg(salario_medio_mensal), 2) AS salario_medio,
  quantile_disc(salario_medio_mensal, 0.5) AS salario_mediano,
  quantile_disc(salario_medio_mensal, 0.25) AS salario_p25,
  quantile_disc(salario_medio_mensal, 0.75) AS salario_p75,
  count(*) >= 30 AS amostra_suficiente
FROM silver WHERE salario_medio_mensal IS NOT NULL GROUP BY survey_year, senioridade"""))
def a1_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_stats(
        respondents(spark, sf_dir), ["survey_year", "senioridade"], SALARY, exact=True
    )


@entry("A2", with_silver("""
SELECT cargo, count(*) AS respondentes, count(salario_medio_mensal) AS com_salario,
  count(usa_ia_generativa) AS responderam,
  CAST(sum(CAST(usa_ia_generativa AS INTEGER)) AS BIGINT) AS usam,
  round(avg(idade), 1) AS idade_media
FROM silver GROUP BY cargo"""))
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return respondents(spark, sf_dir).groupBy("cargo").agg(
        _count().alias("respondentes"),
        F.count(SALARY).alias("com_salario"),
        F.count("usa_ia_generativa").alias("responderam"),
        F.sum(X.marked(F.col("usa_ia_generativa"))).alias("usam"),
        F.round(F.avg("idade"), 1).alias("idade_media"),
    )


@entry("A3", with_silver("SELECT DISTINCT regiao, true AS dentro_do_limite FROM silver"))
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch keeps its rank bound: each answer's true rank is within n / accuracy."""
    accuracy = 200
    people = respondents(spark, sf_dir).select("regiao", "valor")
    sketch = segments.with_percentiles(
        people.groupBy("regiao").agg(
            _count().alias("n"),
            segments.percentile_columns("valor", segments.PERCENTILES, accuracy).alias("_s"),
        ),
        "_s", segments.PERCENTILES, digits=6,
    )
    joined = people.join(sketch, "regiao")
    within = F.lit(True)
    ranks = []
    for name, p in segments.PERCENTILES.items():
        ranks += [
            F.sum((F.col("valor") < F.col(name)).cast("long")).alias(f"_below_{name}"),
            F.sum((F.col("valor") <= F.col(name)).cast("long")).alias(f"_upto_{name}"),
        ]
        slack = F.col("n") / accuracy + 1
        target = F.col("n") * p
        within = within & (F.col(f"_below_{name}") <= target + slack)
        within = within & (F.col(f"_upto_{name}") >= target - slack)
    counted = joined.groupBy("regiao").agg(F.max("n").alias("n"), *ranks)
    return counted.select("regiao", within.alias("dentro_do_limite"))


@entry("A3_exact", with_silver("""
SELECT genero, senioridade, count(valor) AS n, quantile_disc(valor, 0.1) AS p10,
  quantile_disc(valor, 0.25) AS p25, quantile_disc(valor, 0.5) AS p50,
  quantile_disc(valor, 0.9) AS p90
FROM silver GROUP BY genero, senioridade"""))
def a3_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p90": 0.9}
    return segments.exact_percentiles(
        respondents(spark, sf_dir), ["genero", "senioridade"], "valor", points
    ).drop("total")


@entry("A3_narrow", """
SELECT l_linestatus, quantile_disc((CAST(l_shipdate AS DATE) - DATE '1970-01-01')::BIGINT * 86400000000000 + l_orderkey, 0.25) AS p25,
  quantile_disc((CAST(l_shipdate AS DATE) - DATE '1970-01-01')::BIGINT * 86400000000000 + l_orderkey, 0.5) AS p50,
  quantile_disc((CAST(l_shipdate AS DATE) - DATE '1970-01-01')::BIGINT * 86400000000000 + l_orderkey, 0.99) AS p99, count(*) AS n
FROM lineitem GROUP BY l_linestatus""")
def a3_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longs beyond the whole numbers of a double, close together, in two segments of half of all rows each."""
    moment = F.unix_date(F.to_date("l_shipdate")).cast("long") * F.lit(86_400 * 1_000_000_000) + F.col("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", moment.alias("momento"))
    points = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    return segments.exact_percentiles(lines, ["l_linestatus"], "momento", points).drop("total")


@entry("A4", with_silver("""
SELECT cargo, regiao,
  CAST(sum(CASE WHEN survey_year = 1996 THEN n ELSE 0 END) AS BIGINT) AS n_1996,
  CAST(sum(CASE WHEN survey_year = 1998 THEN n ELSE 0 END) AS BIGINT) AS n_1998,
  CAST(sum(CASE WHEN survey_year = 2000 THEN n ELSE 0 END) AS BIGINT) AS n_2000
FROM (SELECT survey_year, cargo, regiao, count(*) AS n FROM silver GROUP BY ALL)
GROUP BY cargo, regiao"""))
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {f"n_{year}": (year, "n") for year in (1996, 1998, 2000)}
    return compare.editions_side_by_side(
        by_year(spark, sf_dir, "cargo", "regiao"), ["cargo", "regiao"], "survey_year", columns, "sum"
    )


@entry("A5", with_silver("""
SELECT regiao, max(CASE WHEN survey_year = 1996 THEN m END) AS mediana_1996,
  max(CASE WHEN survey_year = 1998 THEN m END) AS mediana_1998,
  max(CASE WHEN survey_year = 2000 THEN m END) AS mediana_2000
FROM (SELECT survey_year, regiao, quantile_disc(salario_medio_mensal, 0.5) AS m
      FROM silver GROUP BY survey_year, regiao)
GROUP BY regiao"""))
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    medians = segments.segment_stats(
        respondents(spark, sf_dir), ["survey_year", "regiao"], SALARY, {"m": 0.5}
    )
    columns = {f"mediana_{year}": (year, "m") for year in (1996, 1998, 2000)}
    return compare.editions_side_by_side(medians, ["regiao"], "survey_year", columns)


def _rates(spark: SparkSession, sf_dir: str, null_as_false: bool) -> DataFrame:
    flags = {
        "pct_usa_ia": F.col("usa_ia_generativa"),
        "pct_remoto": F.col("modelo_trabalho") == WORDS.remote,
    }
    return segments.rate_among_answered(
        respondents(spark, sf_dir), ["survey_year", "cargo"], flags, null_as_false
    )


@entry("A6", with_silver("""
SELECT survey_year, cargo, round(avg(CAST(usa_ia_generativa AS INTEGER)) * 100, 2) AS pct_usa_ia,
  round(avg(CAST(modelo_trabalho = 'R' AS INTEGER)) * 100, 2) AS pct_remoto
FROM silver GROUP BY survey_year, cargo"""))
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir, null_as_false=False)


@entry("A7", with_silver("""
SELECT survey_year, cargo,
  round(avg(CASE WHEN usa_ia_generativa THEN 1.0 ELSE 0.0 END) * 100, 2) AS pct_usa_ia,
  round(avg(CASE WHEN modelo_trabalho = 'R' THEN 1.0 ELSE 0.0 END) * 100, 2) AS pct_remoto
FROM silver GROUP BY survey_year, cargo"""))
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir, null_as_false=True)


@entry("A8", with_silver("""
SELECT cargo, count(*) AS respondentes,
  round(100.0 * sum(CAST(usa_ia_generativa AS INTEGER)) / nullif(count(usa_ia_generativa), 0), 2)
    AS pct_usa_ia
FROM silver GROUP BY cargo"""))
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.ratio_of_sums(
        lake(spark, sf_dir).mart("gold_adocao_ia"), ["cargo"],
        {"pct_usa_ia": ("usam_ia", "base_uso_pessoal")}, sums={"respondentes": "respondentes"},
    )


@entry("A9", with_silver("""
SELECT CASE WHEN lower(setor_empresa) LIKE '%build%' OR lower(setor_empresa) LIKE '%auto%'
            THEN 'CONSTRUCTION' ELSE 'OTHER' END AS grupo, genero, count(*) AS n
FROM silver GROUP BY 1, 2"""))
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = X.sector_group(
        F.col("setor_empresa"), WORDS.sector_words, WORDS.sector_name, WORDS.other_sectors
    )
    return respondents(spark, sf_dir).groupBy(group.alias("grupo"), "genero").agg(_count().alias("n"))


_A10 = "\n  UNION ALL ".join(
    f"SELECT '{cut}' AS dimensao, {cut} AS categoria, salario_medio_mensal FROM silver"
    for cut in ("cargo", "senioridade", "regiao", "modelo_trabalho", "genero")
)


@entry("A10", with_silver(f"""
SELECT dimensao, categoria, count(*) AS respondentes,
  round(avg(salario_medio_mensal), 2) AS salario_medio,
  quantile_disc(salario_medio_mensal, 0.5) AS salario_mediano,
  quantile_disc(salario_medio_mensal, 0.25) AS salario_p25,
  quantile_disc(salario_medio_mensal, 0.75) AS salario_p75,
  count(*) >= 30 AS amostra_suficiente
FROM ({_A10}) WHERE categoria IS NOT NULL AND salario_medio_mensal IS NOT NULL
GROUP BY dimensao, categoria"""))
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = ("cargo", "senioridade", "regiao", "modelo_trabalho", "genero")
    return segments.multi_cut_stats(
        respondents(spark, sf_dir), [], {cut: cut for cut in cuts}, SALARY, exact=True
    )


# --- windows over aggregates ---------------------------------------------------------------

_BY = "(SELECT survey_year, {0}, count(*) AS n FROM silver GROUP BY survey_year, {0})"


@entry("W1", with_silver(f"""
SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY survey_year), 2) AS pct
FROM {_BY.format('regiao')}"""))
def w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.share_within(by_year(spark, sf_dir, "regiao"), "n", ["survey_year"], "pct")


@entry("W2", with_silver(f"""
SELECT *, round(n * 100.0 / sum(n) OVER (PARTITION BY survey_year, regiao), 2) AS pct
FROM {_BY.format('regiao, genero')}"""))
def w2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = by_year(spark, sf_dir, "regiao", "genero")
    return compare.share_within(counted, "n", ["survey_year", "regiao"], "pct")


@entry("W3", with_silver("""
SELECT survey_year, genero, count(*) AS n,
  round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY survey_year), 2) AS pct,
  CAST(sum(sum(idade)) OVER (PARTITION BY survey_year) AS BIGINT) AS idade_total
FROM silver GROUP BY survey_year, genero"""))
def w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate inside a window, as Spark SQL writes it."""
    respondents(spark, sf_dir).createOrReplaceTempView("w3_respondentes")
    return spark.sql("""
        SELECT survey_year, genero, count(*) AS n,
          round(100.0D * count(*) / sum(count(*)) OVER (PARTITION BY survey_year), 2) AS pct,
          sum(sum(idade)) OVER (PARTITION BY survey_year) AS idade_total
        FROM w3_respondentes GROUP BY survey_year, genero""")


def _medians(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return segments.segment_stats(
        respondents(spark, sf_dir), ["survey_year", *keys], SALARY, {"mediana": 0.5}
    ).select("survey_year", *keys, "mediana")


_MEDIANS = (
    "(SELECT survey_year, {0}, quantile_disc(salario_medio_mensal, 0.5) AS mediana FROM silver"
    " WHERE salario_medio_mensal IS NOT NULL GROUP BY survey_year, {0})"
)


@entry("W4", with_silver(f"""
SELECT *, max(CASE WHEN genero = 'P' THEN mediana END) OVER (PARTITION BY survey_year, senioridade)
  AS referencia
FROM {_MEDIANS.format('senioridade, genero')}"""))
def w4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.reference_value(
        _medians(spark, sf_dir, "senioridade", "genero"), "mediana", "genero",
        WORDS.reference_gender, ["survey_year", "senioridade"], "referencia",
    )


@entry("W5", with_silver(f"""
SELECT survey_year, senioridade, genero, mediana,
  round((mediana - r) * 100.0 / r, 2) AS gap_pct
FROM (SELECT *, max(CASE WHEN genero = 'P' THEN mediana END)
               OVER (PARTITION BY survey_year, senioridade) AS r
      FROM {_MEDIANS.format('senioridade, genero')})"""))
def w5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.gap_to_reference(
        _medians(spark, sf_dir, "senioridade", "genero"), "mediana", "genero",
        WORDS.reference_gender, ["survey_year", "senioridade"], "gap_pct",
    )


@entry("W6", with_silver(f"""
SELECT *, round(100.0 * mediana / max(CASE WHEN regiao = 'EUROPE' THEN mediana END)
          OVER (PARTITION BY survey_year), 1) AS indice
FROM {_MEDIANS.format('regiao')}"""))
def w6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.gap_to_reference(
        _medians(spark, sf_dir, "regiao"), "mediana", "regiao", WORDS.reference_region,
        ["survey_year"], "indice", kind="index", digits=1,
    )


@entry("W7", with_silver(f"""
SELECT *, round(100.0 * (mediana - first_value(mediana) OVER w) / first_value(mediana) OVER w, 1)
  AS premio_pct
FROM {_MEDIANS.format('senioridade')} WHERE senioridade IS NOT NULL
WINDOW w AS (PARTITION BY survey_year ORDER BY senioridade)"""))
def w7(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _medians(spark, sf_dir, "senioridade").where(F.col("senioridade").isNotNull())
    return compare.premium_vs_first(
        levels, "mediana", ["survey_year"], "senioridade", WORDS.seniority_order, "premio_pct"
    )


# --- sort, limit, top-k ------------------------------------------------------------------


@entry("O1", with_silver(f"""
SELECT *, row_number() OVER (ORDER BY survey_year, n DESC, cargo) - 1 AS posicao FROM {_BY.format('cargo')}"""))
def o1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _positions(by_year(spark, sf_dir, "cargo").orderBy("survey_year", F.desc("n"), "cargo"))


@entry("O2", with_silver(f"""
SELECT *, row_number() OVER (ORDER BY survey_year, CASE senioridade WHEN '1-URGENT' THEN 1
  WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '5-LOW' THEN 4 ELSE 5 END) - 1 AS posicao
FROM {_BY.format('senioridade')}"""))
def o2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = by_year(spark, sf_dir, "senioridade")
    return _positions(compare.in_order(counted, "senioridade", WORDS.seniority_order, F.col("survey_year")))


def _positions(ordered: DataFrame) -> DataFrame:
    """The place of each row in a sorted table of a few hundred rows."""
    return ordered.coalesce(1).withColumn("posicao", F.monotonically_increasing_id())


@entry("O3", with_silver("""
SELECT respondente_id, valor FROM silver ORDER BY valor DESC, respondente_id LIMIT 20"""))
def o3(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = respondents(spark, sf_dir).select("respondente_id", "valor")
    return people.orderBy(F.desc("valor"), "respondente_id").limit(20)


@entry("O4", with_silver("""
SELECT cargo, survey_year, respondente_id, valor
FROM (SELECT *, row_number() OVER (PARTITION BY cargo ORDER BY valor DESC, respondente_id) AS k
      FROM (SELECT *, max(survey_year) OVER (PARTITION BY cargo) AS y FROM silver)
      WHERE survey_year = y)
WHERE k <= 7"""))
def o4(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = respondents(spark, sf_dir).select("cargo", "survey_year", "respondente_id", "valor")
    order = [F.desc("valor"), F.asc("respondente_id")]
    return compare.top_k(people, ["cargo"], order, 7, latest_of="survey_year")


@entry("O5", with_silver("""
SELECT regiao, survey_year, respondente_id, valor
FROM (SELECT *, row_number() OVER (PARTITION BY regiao
               ORDER BY survey_year DESC, valor DESC, respondente_id DESC) AS k FROM silver)
WHERE k = 1"""))
def o5(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["survey_year", "valor", "respondente_id"]
    return compare.arg_max(
        respondents(spark, sf_dir), ["regiao"], [F.col(c) for c in columns], columns
    )


@entry("O6", with_silver("""
SELECT CAST(v.posicao AS INTEGER) AS posicao, v.senioridade, s.n
FROM (VALUES (1, '5-LOW'), (2, '3-MEDIUM'), (3, '0-LEAD'), (4, '1-URGENT')) v(posicao, senioridade)
LEFT JOIN (SELECT senioridade, count(*) AS n FROM silver GROUP BY senioridade) s
  ON v.senioridade = s.senioridade"""))
def o6(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = respondents(spark, sf_dir).groupBy("senioridade").agg(_count().alias("n"))
    return compare.reindex(counted, "senioridade", ["5-LOW", "3-MEDIUM", "0-LEAD", "1-URGENT"])


# --- filters -----------------------------------------------------------------------------


@entry("F1", with_silver("""
SELECT regiao, count(*) AS n FROM silver
WHERE salario_medio_mensal IS NOT NULL AND senioridade IS NOT NULL GROUP BY regiao"""))
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.col(SALARY).isNotNull() & F.col("senioridade").isNotNull()
    return respondents(spark, sf_dir).where(known).groupBy("regiao").agg(_count().alias("n"))


@entry("F2", with_silver("""
SELECT senioridade, count(*) AS n FROM silver
WHERE senioridade IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '0-LEAD') GROUP BY senioridade"""))
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = respondents(spark, sf_dir).where(F.col("senioridade").isin(*WORDS.query_levels))
    return kept.groupBy("senioridade").agg(_count().alias("n"))


@entry("F3", with_silver("""
SELECT senioridade, count(*) AS n FROM silver WHERE senioridade <> '5-LOW' GROUP BY senioridade"""))
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Also drops NULL, as the three-valued comparison does."""
    kept = respondents(spark, sf_dir).where(F.col("senioridade") != "5-LOW")
    return kept.groupBy("senioridade").agg(_count().alias("n"))


@entry("F4", with_silver("""
SELECT cargo, count(*) AS n FROM silver WHERE usa_ia_generativa GROUP BY cargo"""))
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = respondents(spark, sf_dir).where(F.col("usa_ia_generativa"))
    return kept.groupBy("cargo").agg(_count().alias("n"))


@entry("F5", with_silver("SELECT cargo, count(*) AS n FROM silver WHERE survey_year = 1998 GROUP BY cargo"))
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = respondents(spark, sf_dir).where(F.col("survey_year") == 1998)
    return kept.groupBy("cargo").agg(_count().alias("n"))


@entry("F6", with_silver("""
SELECT survey_year, regiao, cargo, senioridade, count(*) AS n FROM silver
GROUP BY survey_year, regiao, cargo, senioridade HAVING count(*) >= 30"""))
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_year(spark, sf_dir, "regiao", "cargo", "senioridade").where(F.col("n") >= 30)


@entry("F7", with_silver("""
SELECT * FROM (SELECT nivel_ensino,
    CAST(sum(CASE WHEN senioridade = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS juniores,
    CAST(sum(CASE WHEN senioridade = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS seniores
  FROM silver GROUP BY nivel_ensino)
WHERE juniores + seniores >= 240"""))
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    def people(level: str):
        return F.sum(F.when(F.col("senioridade") == level, 1).otherwise(0))

    return (
        respondents(spark, sf_dir)
        .groupBy("nivel_ensino")
        .agg(people(WORDS.junior).alias("juniores"), people(WORDS.senior).alias("seniores"))
        .where(F.col("juniores") + F.col("seniores") >= 240)
    )


@entry("F8", with_silver("""
SELECT item, count(*) AS n
FROM (SELECT unnest(list_append(list_append(linguagens, NULL), '')) AS item FROM silver
      WHERE linguagens IS NOT NULL)
WHERE item IS NOT NULL AND item <> '' GROUP BY item"""))
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and NULL items, added to every answered list here, never reach the counts."""
    blanks = F.array(F.lit(None).cast("string"), F.lit(""))
    items = respondents(spark, sf_dir).select(
        F.explode(F.concat("linguagens", blanks)).alias("item")
    )
    kept = items.where(F.col("item").isNotNull() & (F.col("item") != ""))
    return kept.groupBy("item").agg(_count().alias("n"))


# --- joins and generators ------------------------------------------------------------------


@entry("J1", with_silver("""
SELECT i.survey_year, i.tecnologia, i.usuarios, b.base_respondentes
FROM (SELECT survey_year, tecnologia, count(*) AS usuarios
      FROM (SELECT survey_year, unnest(linguagens) AS tecnologia FROM silver) GROUP BY ALL) i
JOIN (SELECT survey_year, count(*) AS base_respondentes FROM silver
      WHERE linguagens IS NOT NULL GROUP BY survey_year) b ON i.survey_year = b.survey_year"""))
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.adoption_with_base_join(
        respondents(spark, sf_dir), ["survey_year"], "linguagens"
    )


@entry("J2", with_silver("""
SELECT linguagem, count(*) AS n, CAST(sum(valor > 250000) AS BIGINT) AS acima
FROM (SELECT valor, unnest(linguagens) AS linguagem FROM silver) GROUP BY linguagem"""))
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = respondents(spark, sf_dir).select("valor", F.explode("linguagens").alias("linguagem"))
    return exploded.groupBy("linguagem").agg(
        _count().alias("n"), F.sum((F.col("valor") > 250000).cast("long")).alias("acima")
    )


# --- set operations and quality --------------------------------------------------------------


@entry("E1", with_silver("""
SELECT cargo, regiao, CAST(NULL AS VARCHAR) AS genero FROM silver WHERE survey_year % 2 = 0
UNION ALL SELECT cargo, NULL, genero FROM silver WHERE survey_year % 2 = 1"""))
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even and odd editions, which are all rows, with different columns each."""
    people = respondents(spark, sf_dir)
    even = people.where(F.col("survey_year") % 2 == 0).select("cargo", "regiao")
    odd = people.where(F.col("survey_year") % 2 == 1).select("genero", "cargo")
    return even.unionByName(odd, allowMissingColumns=True)


@entry("E2", with_silver("""
SELECT survey_year, count(*) FILTER (resultado_ia_empresa IS NOT NULL) AS primeiro,
  count(*) FILTER (linguagens IS NOT NULL) AS segundo,
  count(*) FILTER (resultado_ia_empresa IS NOT NULL AND linguagens IS NOT NULL) AS ambos
FROM silver GROUP BY survey_year"""))
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.block_overlap(
        respondents(spark, sf_dir), ["survey_year"],
        F.col("resultado_ia_empresa").isNotNull(), F.col("linguagens").isNotNull(),
    )


_BLOCKS = ["linguagens", "bancos_dados", "resultado_ia_empresa", "senioridade", "salario_medio_mensal", "modelo_trabalho"]


@entry("E2_matrix", with_silver("\nUNION ALL ".join(
    f"SELECT survey_year, '{a}' AS bloco, '{b}' AS outro, count({a}) AS primeiro, count({b}) AS segundo,"
    f" count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS ambos FROM silver GROUP BY survey_year"
    for i, a in enumerate(_BLOCKS) for b in _BLOCKS[i + 1:])))
def e2_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of six questions, from one scan."""
    answered = {name: F.col(name).isNotNull() for name in _BLOCKS}
    patterns = quality.answer_patterns(respondents(spark, sf_dir), ["survey_year"], answered)
    return quality.block_overlaps(patterns, ["survey_year"], _BLOCKS)


@entry("E3", with_silver("""
SELECT cargo, genero, senioridade,
  count(*) FILTER (survey_year % 2 = 0) - count(*) FILTER (survey_year % 2 = 1) AS sobra
FROM silver GROUP BY cargo, genero, senioridade
HAVING count(*) FILTER (survey_year % 2 = 0) <> count(*) FILTER (survey_year % 2 = 1)"""))
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even against odd editions, which are all rows."""
    people = respondents(spark, sf_dir)
    columns = ["cargo", "genero", "senioridade"]
    left = people.where(F.col("survey_year") % 2 == 0).select(*columns)
    right = people.where(F.col("survey_year") % 2 == 1).select(*columns)
    return quality.table_difference(left, right)


@entry("E3_equal", "SELECT CAST(0 AS BIGINT) AS diferentes")
def e3_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against itself read in other partitions has no differing row."""
    orders = table(spark, sf_dir, "orders")
    difference = quality.table_difference(orders, orders.repartition("o_custkey"))
    return difference.groupBy().agg(_count().alias("diferentes"))


@entry("V1", with_silver("SELECT 'respondentes' AS tabela, count(*) = 0 AS vazia FROM silver"))
def v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.is_empty(respondents(spark, sf_dir), "respondentes")


_V2 = ["cargo", "senioridade", "salario_medio_mensal", "modelo_trabalho", "resultado_ia_empresa"]


@entry("V2", with_silver("\nUNION ALL ".join(
    f"SELECT count(*) AS linhas, '{c}' AS coluna, count({c}) AS preenchidas,"
    f" count({c}) = 0 AS toda_nula FROM silver" for c in _V2)))
def v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.column_fill(respondents(spark, sf_dir).select(*_V2))


@entry("V3", with_silver("""
SELECT 'Q1.3' AS consulta, count(*) AS linhas, '' AS problemas, 'OK' AS status
FROM (SELECT DISTINCT survey_year, senioridade FROM silver
      WHERE senioridade IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
UNION ALL SELECT 'vazia', 0, '0 linhas', 'FALHA'
UNION ALL SELECT 'nula', count(*), 'colunas nulas: resultado_ia_empresa', 'FALHA'
FROM silver"""))
def v3(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound = lake(spark, sf_dir)
    return quality.query_report(
        {
            "Q1.3": QUERIES["Q1.3"](bound),
            "vazia": bound.silver.where(F.col("regiao") == WORDS.undeclared).select("cargo"),
            "nula": bound.silver.select("cargo", F.lit(None).cast("string").alias("resultado_ia_empresa")),
        }
    )


_FOUND = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "VARCHAR[]": "array<string>"}


def _contract_sql() -> str:
    """Types and filled values of every table, as DuckDB has them in the marts' own oracles and in the respondent table."""
    from surveylake.bindings.marts import REGISTRY as marts

    built = {name: marts.oracles[entry_] for name, entry_ in MART_ENTRIES.items()}
    built["silver"] = with_silver("SELECT * EXCLUDE (valor) FROM silver")
    kinds = " ".join(f"WHEN '{found}' THEN '{kind}'" for found, kind in _FOUND.items())
    parts = []
    for name, sql in built.items():
        contract = {**SILVER_COLUMNS, "survey_year": "int"} if name == "silver" else GOLD_COLUMNS[name]
        present = [c for c in contract if name != "silver" or c in SILVER_BOUND]
        shown = ", ".join(f"{{'coluna': '{c}', 'esperado': '{contract[c]}', 'tipo': any_value(typeof({c})), 'preenchidas': count({c})}}" for c in present)
        parts.append(f"SELECT '{name}' AS tabela, unnest([{shown}]) AS r FROM ({sql})")
        absent = [c for c in contract if c not in present]
        parts += [f"SELECT '{name}', {{'coluna': '{c}', 'esperado': '{contract[c]}', 'tipo': NULL::VARCHAR, 'preenchidas': NULL::BIGINT}}" for c in absent]
    union = " UNION ALL ".join(parts)
    return f"""
SELECT tabela, r.coluna AS coluna, r.esperado AS esperado, encontrado, r.preenchidas AS preenchidas,
  encontrado IS NOT DISTINCT FROM r.esperado AS confere
FROM (SELECT *, CASE r.tipo {kinds} END AS encontrado FROM ({union}))"""


MART_ENTRIES = {
    "gold_perfil_mercado": "G1", "gold_remuneracao": "G2", "gold_diversidade_genero": "G3", "gold_tecnologias": "G4", "gold_adocao_ia": "G5",
    "gold_impacto_ia": "G6", "gold_remuneracao_regional": "G7", "gold_modelo_trabalho": "G8", "gold_evolucao_anual": "G9",
}
# The columns that the respondent binding has; the others of the contract are reported as absent.
SILVER_BOUND = (
    "survey_year respondente_id idade genero nivel_ensino setor_empresa cargo senioridade salario_medio_mensal tempo_experiencia_dados"
    " modelo_trabalho busca_nova_oportunidade tipo_uso_ia usa_ia_generativa empresa_prioriza_ia resultado_ia_empresa linguagens"
    " bancos_dados cloud_utilizada ferramentas_bi regiao"
).split()


@entry("V4", _contract_sql())
def v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts of the respondent table and of all nine marts against the tables themselves."""
    bound = lake(spark, sf_dir)
    tables = {name: (bound.mart(name), GOLD_COLUMNS[name]) for name in MART_ENTRIES}
    tables["silver"] = (bound.silver.drop("valor"), {**SILVER_COLUMNS, "survey_year": "int"})
    return quality.contracts_report(tables)


@entry("V5", """
SELECT CAST(coalesce(y, v.survey_year) AS INTEGER) AS survey_year, v.survey_year IS NOT NULL AS esperada,
  coalesce(linhas, 0) AS linhas, coalesce(chaves, 0) AS chaves, coalesce(repetidas, 0) AS repetidas
FROM (VALUES (1994), (1996), (1998), (2000)) v(survey_year)
FULL JOIN (SELECT y, CAST(sum(n) AS BIGINT) AS linhas, count(*) AS chaves,
                  CAST(sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS repetidas
           FROM (SELECT year(l_shipdate) AS y, l_orderkey, l_linenumber, count(*) AS n
                 FROM lineitem GROUP BY ALL) GROUP BY y) ON y = v.survey_year""")
def v5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year of the lines; four of them are expected, one of which has none."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("survey_year"),
        F.concat_ws("/", "l_orderkey", "l_linenumber").alias("respondente_id"),
    )
    return quality.edition_report(lines, (1994, 1996, 1998, 2000))
