"""Stored state over the star-schema tables: ledgers, refreshed marts, digests, sketches, unmatched answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.bindings.editions import EXPECTED, answers, export_raw, to_silver, written_edition
from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import respondents, table, with_silver
from surveylake.operators import quality, sketches
from surveylake.operators.digest import digest_difference
from surveylake.operators.ranking import first_of_each
from surveylake.operators.unmatched import SPELLINGS_ERROR, by_rules, unmatched_answers
from surveylake.session import scratch_path
from surveylake.sources import bucketed, gold, ledger

REGISTRY = Registry()
entry = REGISTRY.entry


@entry("S1_ledger", f"""
WITH {EXPECTED}, runs AS (
  SELECT 1 AS rodada, survey_year, 'nova' AS situacao, count(*) AS linhas FROM base GROUP BY survey_year
  UNION ALL SELECT 2, survey_year, 'igual', 0 FROM base GROUP BY survey_year
  UNION ALL SELECT 3, survey_year, CASE WHEN survey_year = 2024 THEN 'substituida' ELSE 'igual' END,
    count(*) FILTER (survey_year = 2024 AND c_custkey % 2 = 0) FROM base GROUP BY survey_year)
SELECT rodada, survey_year, situacao, linhas FROM runs""")
def s1_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over the exports: all are new, none has changed, one was replaced by half of its rows."""
    raw_path = export_raw(spark, sf_dir)
    home = raw_path.removesuffix("/raw")
    rows = []
    for number in (1, 2, 3):
        if number == 3:
            even = answers(spark, sf_dir).where(F.substring("comment", 22, 40).rlike(r"[02468]\n fim$"))
            written_edition(even, 2024, raw_path)
        run = ledger.ingest_changes(spark, raw_path, f"{home}/bronze", f"{home}/ledger")
        rows += [(number, year, kind, run.written.get(year, 0)) for _, year, kind in run.exports]
    return spark.createDataFrame(rows, "rodada int, survey_year int, situacao string, linhas bigint")


@entry("S9_refresh", f"""
WITH {EXPECTED}
SELECT survey_year, count(*) AS total_respondentes, survey_year = 2024 AS refeita FROM base
WHERE survey_year <> 2024 OR c_nationkey % 2 = 0 GROUP BY survey_year""")
def s9_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts by edition after one edition of Silver lost half of its nations: only that one is built again."""
    silver_path = to_silver(spark, sf_dir)
    gold_path = silver_path.removesuffix("silver") + "gold_by_edition"
    gold.refresh_marts(spark, silver_path, gold_path)
    # Ages are 20 and the number of the nation.
    kept = spark.read.parquet(silver_path).where((F.col("survey_year") == 2024) & (F.col("idade") % 2 == 0))
    changed = scratch_path(spark, "edition")
    kept.write.parquet(changed)
    spark.read.parquet(changed).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("survey_year").parquet(silver_path)
    written = gold.refresh_marts(spark, silver_path, gold_path)["written"]
    marts = spark.read.parquet(f"{gold_path}/gold_evolucao_anual")
    return marts.select("survey_year", "total_respondentes", F.col("survey_year").isin(written).alias("refeita"))


_CHANGED = "l_orderkey % 997 = 5"
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax"]


@entry("E3_digest", f"""
WITH sides AS (
  SELECT {', '.join(_LINE)}, 1 AS side FROM lineitem
  UNION ALL SELECT {', '.join(_LINE[:-1])}, CASE WHEN {_CHANGED} THEN l_tax + 1 ELSE l_tax END, -1 FROM lineitem)
SELECT {', '.join(_LINE)}, CAST(sum(side) AS BIGINT) AS sobra FROM sides GROUP BY ALL HAVING sum(side) <> 0""")
def e3_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines against a copy in other partitions in which the lines of some orders differ."""
    lines = table(spark, sf_dir, "lineitem").select(*_LINE)
    tax = F.when(F.expr(_CHANGED), F.col("l_tax") + 1).otherwise(F.col("l_tax"))
    return digest_difference(lines, lines.withColumn("l_tax", tax).repartition("l_partkey"))


_CUTS = {"regiao": ["regiao"], "cargo e nivel": ["cargo", "senioridade"]}


@entry("A3_sketch", with_silver("""
SELECT dimensao, categoria, count(*) AS respondentes, round(avg(valor), 2) AS media, true AS dentro_do_erro
FROM (SELECT valor, 'regiao' AS dimensao, regiao AS categoria, survey_year FROM silver
      UNION ALL SELECT valor, 'cargo e nivel', concat_ws('/', cargo, senioridade), survey_year FROM silver)
WHERE survey_year % 2 = 0 GROUP BY ALL"""))
def a3_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics over the even editions from sketches stored by edition; ranks are checked against all rows."""
    people = respondents(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    sketches.cut_states(people, ["survey_year"], _CUTS, "valor").write.partitionBy("survey_year").parquet(path)
    stored = spark.read.parquet(path).where(F.col("survey_year") % 2 == 0)
    found = sketches.state_stats(sketches.merged_states(stored, ["dimensao", "categorias"]))
    found = found.select("*", F.array_join("categorias", "/").alias("categoria"))
    cuts = [F.struct(F.lit(name).alias("dimensao"), F.concat_ws("/", *columns).alias("categoria")) for name, columns in _CUTS.items()]
    rows = people.where(F.col("survey_year") % 2 == 0).select("valor", F.inline(F.array(*cuts)))
    joined = rows.join(found, ["dimensao", "categoria"])

    def within(name: str, p: float):
        below = F.avg((F.col("valor") < F.col(name) - 0.01).cast("int"))
        upto = F.avg((F.col("valor") <= F.col(name) + 0.01).cast("int"))
        return (below <= p + sketches.RANK_ERROR) & (upto >= p - sketches.RANK_ERROR)

    checks = reduce(lambda a, b: a & b, (within(name, p) for name, p in sketches.PERCENTILES.items()))
    checked = joined.groupBy("dimensao", "categoria").agg(checks.alias("dentro_do_erro"))
    return found.select("dimensao", "categoria", "respondentes", F.col("salario_medio").alias("media")).join(checked, ["dimensao", "categoria"])


_NAME_RULES = [(r"^(red|blue|hot) ", "colour"), (r" (ring|gear)$", "round")]
_TEXT_RULES = [(r" (the|of) ", "english"), (r" (der|die|das) ", "german")]
_KNOWN = {
    "part": "regexp_matches(p_name, '^(red|blue|hot) | (ring|gear)$')",
    "documents": "regexp_matches(lower(strip_accents(text)), ' (the|of) | (der|die|das) ')",
}


@entry("V2_unmatched", f"""
WITH answers AS (
  SELECT 'p_name' AS campo, trim(p_name) AS a, {_KNOWN['part']} AS known FROM part
  UNION ALL SELECT 'p_brand', trim(p_brand), regexp_matches(lower(p_brand), '^brand#1') FROM part
  UNION ALL SELECT 'text', nullif(trim(text, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(160)), ''), {_KNOWN['documents']} FROM documents)
SELECT campo, count(a) AS respondidas, count(a) FILTER (NOT known) AS sem_regra,
  round(count(a) FILTER (NOT known) * 100.0::DOUBLE / count(a), 2) AS pct_sem_regra, true AS dentro_do_erro
FROM answers GROUP BY campo""")
def v2_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of names, brands and whole documents that no rule knows; spellings against an exact count."""
    parts, documents = table(spark, sf_dir, "part"), table(spark, sf_dir, "documents")
    fields = {
        "p_name": (parts, by_rules("p_name", _NAME_RULES)),
        "p_brand": (parts, by_rules("p_brand", [("^brand#1", "one")])),
        "text": (documents, by_rules("text", _TEXT_RULES)),
    }
    found = []
    for name, (df, field) in fields.items():
        unknown = F.when(field.answer.isNotNull() & ~field.known, field.answer)
        exact = df.groupBy().agg(F.count_distinct(unknown).alias("exatas"))
        # One row each; a join on the name alone would be a nested loop.
        both = unmatched_answers(df, {name: field}).unionByName(exact.withColumn("campo", F.lit(name)), allowMissingColumns=True)
        figures = ("respondidas", "sem_regra", "pct_sem_regra", "grafias", "exatas")
        joined = both.groupBy("campo").agg(*[F.max(figure).alias(figure) for figure in figures])
        near = F.abs(F.col("grafias") - F.col("exatas")) <= F.lit(SPELLINGS_ERROR) * F.col("exatas")
        found.append(joined.select("campo", "respondidas", "sem_regra", "pct_sem_regra", near.alias("dentro_do_erro")))
    return reduce(DataFrame.unionByName, found)


@entry("V2_spellings", f"""
SELECT p_name AS grafia, count(*) AS n FROM part WHERE NOT {_KNOWN['part']} GROUP BY p_name""")
def v2_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of a name that no rule knows; with fewer spellings than are followed, the counts are exact."""
    found = unmatched_answers(table(spark, sf_dir, "part"), {"p_name": by_rules("p_name", _NAME_RULES)}, top=1000)
    return found.select(F.inline("principais"))


# --- tables in buckets ----------------------------------------------------------------------------------------

BUCKETS = 8
_BY_LINE = ["l_quantity", "l_extendedprice", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def bucketed_table(spark: SparkSession, df: DataFrame, name: str) -> str:
    """``df`` written in buckets, then declared anew in a catalog that knows only its folder."""
    path = scratch_path(spark, name)
    run = path.rsplit("-", 1)[-1]
    columns = {column: kind for column, kind in df.dtypes if column != bucketed.EDITION}
    for database in (f"writer_{run}", f"reader_{run}"):
        gold.create_database(spark, database, f"{path}-{database}")
        bucketed.declare(spark, f"{database}.{name}", columns, path, BUCKETS)
        if database.startswith("writer"):
            bucketed.write(df, f"{database}.{name}")
    return f"reader_{run}.{name}"


def bucketed_people(spark: SparkSession, sf_dir: str) -> str:
    return bucketed_table(spark, respondents(spark, sf_dir), "respondents")


def bucketed_lines(spark: SparkSession, sf_dir: str) -> str:
    """Lines by the year of their shipment; the respondent is the order."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("respondente_id"), "l_linenumber", *_BY_LINE,
        F.year("l_shipdate").alias("survey_year"),
    )
    return bucketed_table(spark, lines, "lines")


@entry("S7_buckets", with_silver("""
SELECT CAST(coalesce(y, v.survey_year) AS INTEGER) AS survey_year, v.survey_year IS NOT NULL AS esperada,
  coalesce(linhas, 0) AS linhas, coalesce(linhas, 0) AS chaves, CAST(0 AS BIGINT) AS repetidas
FROM (VALUES (1990), (1996), (1998)) v(survey_year)
FULL JOIN (SELECT survey_year AS y, count(*) AS linhas FROM silver GROUP BY survey_year) ON y = v.survey_year"""))
def s7_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Editions and repeated ids of the bucketed respondent table; ids are counted where they lie."""
    return quality.edition_report(spark.table(bucketed_people(spark, sf_dir)), (1990, 1996, 1998))


@entry("H16_buckets", f"""
SELECT survey_year, l_orderkey AS pedido, l_quantity, l_extendedprice
FROM (SELECT *, year(l_shipdate) AS survey_year,
        row_number() OVER (PARTITION BY year(l_shipdate), l_orderkey ORDER BY {', '.join(_BY_LINE)}) AS k FROM lineitem)
WHERE k = 1""")
def h16_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (year, order) from a bucketed table, without a shuffle."""
    lines = spark.table(bucketed_lines(spark, sf_dir))
    kept = first_of_each(lines, ["survey_year", "respondente_id"], [F.col(c) for c in _BY_LINE])
    return kept.select(
        F.col("survey_year").cast("long").alias("survey_year"), F.col("respondente_id").cast("long").alias("pedido"),
        "l_quantity", "l_extendedprice",
    )


@entry("E2_buckets", with_silver("""
SELECT survey_year, count(a) AS primeiro, count(b) AS segundo, count(a + b) AS ambos
FROM (SELECT CAST(survey_year AS INTEGER) AS survey_year, respondente_id AS id, 1 AS a FROM silver)
FULL JOIN (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS survey_year, CAST(l_orderkey AS VARCHAR) AS id, 1 AS b
           FROM lineitem) USING (survey_year, id)
GROUP BY survey_year"""))
def e2_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed and orders shipped in each year, two tables bucketed alike, and those in both."""
    people, lines = bucketed_people(spark, sf_dir), bucketed_lines(spark, sf_dir)
    return quality.tables_overlap(spark.table(people), spark.table(lines))


_MEASURED = ["idade", "salario_medio_mensal", "usa_ia_generativa", "empresa_prioriza_ia", "valor", "survey_year"]
_TEXTS = ["respondente_id", "genero", "cargo", "senioridade", "regiao", "tipo_uso_ia", "resultado_ia_empresa"]


@entry("S10_statistics", with_silver("\nUNION ALL ".join(
    f"SELECT '{c}' AS coluna, count(*) - count({c}) AS nulos,"
    + (f" CAST(min({c}) AS VARCHAR) AS minimo, CAST(max({c}) AS VARCHAR) AS maximo" if c in _MEASURED else " NULL::VARCHAR, NULL::VARCHAR")
    + " FROM silver" for c in _MEASURED + _TEXTS)))
def s10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls and bounds of columns as the catalog keeps them after one analysis of the table."""
    people = bucketed_people(spark, sf_dir)
    bucketed.analyse(spark, people)
    return bucketed.column_statistics(spark, people).where(F.col("coluna").isin(_MEASURED + _TEXTS))


@entry("S10_volume", with_silver("SELECT survey_year, count(*) AS linhas FROM silver GROUP BY survey_year"))
def s10_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each edition from the catalog of the analysed table; no file is read for them."""
    people = bucketed_people(spark, sf_dir)
    bucketed.analyse(spark, people)
    return bucketed.edition_rows(spark, people)
