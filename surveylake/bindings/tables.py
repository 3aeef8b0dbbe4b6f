"""Binding of star-schema tables to the respondent table, in Spark and as oracle SQL.

An order is a respondent, its year the edition, its customer's segment the job, its priority the
level (``4-NOT SPECIFIED`` is a missing answer), its status the gender. Its lines answer the
multi-select blocks and the AI questions; an order without lines skipped those blocks. The salary
is the midpoint of a price band and missing for customers in debt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.functions.rules import Vocabulary
from surveylake.plans.lake import Lake

WORDS = Vocabulary(
    reference_gender="P",
    focus_gender="F",
    seniority_order=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    query_levels=("1-URGENT", "2-HIGH", "3-MEDIUM", "0-LEAD"),
    junior="1-URGENT",
    senior="3-MEDIUM",
    specialist="5-LOW",
    onsite="A",
    hybrid="N",
    remote="R",
    reference_region="EUROPE",
    compared_region="AFRICA",
    undeclared="UNDECLARED",
    other_job="FURNITURE",
    sector_words=("build", "auto"),
    sector_name="CONSTRUCTION",
    other_sectors="OTHER",
    result_stages=("F-A", "F-N", "F-R", "O-A", "O-N", "O-R", "X-X"),
    stage_in_production="O-R",
    stage_pilot="O-A",
)

RESULT_QUESTION_SINCE = 2000
LANGUAGE_QUESTION_UNTIL = 1999


# Declared schemas: reading a table needs no job to infer one.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _two_letters(code: Column, between: str) -> Column:
    return F.concat(F.char(F.floor(code / 256)), F.lit(between), F.char(code % 256))


def line_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: single answers taken from its lines.

    One-letter flags are compared as character codes, which hash aggregation can update in place.
    """
    flag, status = F.ascii("l_returnflag"), F.ascii("l_linestatus")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("_flag_key"))
        .agg(
            F.max(flag).alias("_flag"),
            F.max(F.col("l_discount") > 0.05).alias("usa_ia_generativa"),
            F.max(F.col("l_tax") > 0.06).alias("empresa_prioriza_ia"),
            F.max(F.col("l_quantity") > 40).alias("busca_nova_oportunidade"),
            F.max(flag * 256 + status).alias("_usage"),
            F.min(status * 256 + flag).alias("_result"),
        )
    )


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: the multi-select blocks, as the distinct part types, brands and flags."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("_block_key"))
        .agg(
            F.collect_set("p_type").alias("_types"),
            F.collect_set("p_brand").alias("bancos_dados"),
            F.collect_set("l_linestatus").alias("cloud_utilizada"),
            F.collect_set("l_returnflag").alias("ferramentas_bi"),
        )
    )


def respondents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The respondent table over orders, customers, nations, regions and lines."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    people = (
        customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    year = F.year("o_orderdate")
    balance = F.col("c_acctbal")
    return (
        orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(line_flags(spark, sf_dir), F.col("o_orderkey") == F.col("_flag_key"), "left")
        .join(line_blocks(spark, sf_dir), F.col("o_orderkey") == F.col("_block_key"), "left")
        .select(
            year.cast("int").alias("survey_year"),
            F.col("o_orderkey").cast("string").alias("respondente_id"),
            F.floor(F.abs(balance) / 250 + 18).cast("int").alias("idade"),
            F.col("o_orderstatus").alias("genero"),
            F.col("n_name").alias("nivel_ensino"),
            F.col("c_mktsegment").alias("setor_empresa"),
            F.col("c_mktsegment").alias("cargo"),
            F.when(
                F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")
            ).alias("senioridade"),
            F.when(balance >= 0, F.floor(F.col("o_totalprice") / 20000) * 20000.0 + 10000.0)
            .alias("salario_medio_mensal"),
            F.when(balance < 0, None)
            .when(balance < 3000, "0-3000")
            .when(balance < 6000, "3000-6000")
            .otherwise("6000+")
            .alias("tempo_experiencia_dados"),
            F.char(F.col("_flag")).alias("modelo_trabalho"),
            "busca_nova_oportunidade",
            _two_letters(F.col("_usage"), "/").alias("tipo_uso_ia"),
            "usa_ia_generativa",
            "empresa_prioriza_ia",
            F.when(
                year >= RESULT_QUESTION_SINCE, _two_letters(F.col("_result"), "-")
            ).alias("resultado_ia_empresa"),
            F.when(year <= LANGUAGE_QUESTION_UNTIL, F.col("_types")).alias("linguagens"),
            "bancos_dados",
            "cloud_utilizada",
            "ferramentas_bi",
            F.col("r_name").alias("regiao"),
            F.col("o_totalprice").alias("valor"),
        )
    )


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    return Lake.over_silver(respondents(spark, sf_dir), WORDS)


# The same table for the oracle.
SILVER_SQL = """
flags AS (
  SELECT l_orderkey AS flag_key,
         max(l_returnflag) AS modelo_trabalho,
         bool_or(l_discount > 0.05) AS usa_ia_generativa,
         bool_or(l_tax > 0.06) AS empresa_prioriza_ia,
         bool_or(l_quantity > 40) AS busca_nova_oportunidade,
         max(l_returnflag || '/' || l_linestatus) AS tipo_uso_ia,
         min(l_linestatus || '-' || l_returnflag) AS result
  FROM lineitem GROUP BY l_orderkey),
blocks AS (
  SELECT l_orderkey AS block_key,
         list(DISTINCT p_type) AS types,
         list(DISTINCT p_brand) AS bancos_dados,
         list(DISTINCT l_linestatus) AS cloud_utilizada,
         list(DISTINCT l_returnflag) AS ferramentas_bi
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY l_orderkey),
silver AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS survey_year,
         CAST(o_orderkey AS VARCHAR) AS respondente_id,
         CAST(floor(abs(c_acctbal) / 250 + 18) AS INTEGER) AS idade,
         o_orderstatus AS genero,
         n_name AS nivel_ensino,
         c_mktsegment AS setor_empresa,
         c_mktsegment AS cargo,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS senioridade,
         CASE WHEN c_acctbal >= 0
              THEN CAST(floor(o_totalprice / 20000) * 20000 + 10000 AS DOUBLE)
         END AS salario_medio_mensal,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN '0-3000'
              WHEN c_acctbal < 6000 THEN '3000-6000' ELSE '6000+' END AS tempo_experiencia_dados,
         modelo_trabalho, busca_nova_oportunidade, tipo_uso_ia, usa_ia_generativa,
         empresa_prioriza_ia,
         CASE WHEN year(o_orderdate) >= 2000 THEN result END AS resultado_ia_empresa,
         CASE WHEN year(o_orderdate) <= 1999 THEN types END AS linguagens,
         bancos_dados, cloud_utilizada, ferramentas_bi,
         r_name AS regiao,
         o_totalprice AS valor
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       LEFT JOIN flags ON o_orderkey = flag_key
       LEFT JOIN blocks ON o_orderkey = block_key)"""


def with_silver(select: str, *tables: str) -> str:
    """Oracle text: the respondent table, further named tables, then ``select``."""
    return "WITH " + ",\n".join([SILVER_SQL, *tables]) + "\n" + select
