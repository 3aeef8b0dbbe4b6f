"""Header rules over text columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import table
from surveylake.functions import headers as H
from surveylake.functions.text import strip_accents
from surveylake.operators.harmonise import unique_names
from surveylake.operators.pattern_index import match_patterns

REGISTRY = Registry()
entry = REGISTRY.entry



def raw_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part is a question: size the number, name the statement, type the header syntax."""
    size, kind = F.col("p_size").cast("string"), F.col("p_type")
    name, brand = F.col("p_name"), F.col("p_brand")

    def text(*parts):
        return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])

    raw = (
        F.when(kind == "ECONOMY", text("('P", size, "_a ', '", name, "')"))
        .when(kind == "MEDIUM", text("('P", size, "_b_1 ', \"d'", name, ' + ação")'))
        .when(kind == "SMALL", text(size, ".c_", name))
        .when(kind == "STANDARD", text(size, ".d.1 ", brand))
        .when(kind == "LARGE", text("Unnamed: ", size))
        .otherwise(text("  ", name, "/", brand, " "))
    )
    return table(spark, sf_dir, "part").select(
        brand.alias("edition"), F.col("p_partkey").alias("pos"), raw.alias("raw")
    )


_SLUG = (
    "trim(regexp_replace(replace(translate(lower(strip_accents({0})), '/-', '  '), '+', ' mais '),"
    " '[^a-z0-9]+', '_', 'g'), '_')"
)


@entry("H1", "SELECT doc_id, md5(strip_accents(text)) AS sem_acentos FROM documents")
def h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.md5(strip_accents(F.col("text"))).alias("sem_acentos"))


@entry("H2", f"SELECT page_id, {_SLUG.format('url')} AS slug FROM pages")
def h2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", H.slugify(F.col("url")).alias("slug"))


@entry("H2_text", f"SELECT doc_id, md5({_SLUG.format('text')}) AS slug FROM documents")
def h2_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.md5(H.slugify(F.col("text"))).alias("slug"))


_CODE = (
    "CASE p_type WHEN 'ECONOMY' THEN 'P' || CAST(p_size AS VARCHAR(9)) || '_A '"
    " WHEN 'SMALL' THEN CAST(p_size AS VARCHAR(9)) || '.d.1'"
    " WHEN 'PROMO' THEN ' p' || CAST(p_size AS VARCHAR(9)) || '-b- '"
    " ELSE CAST(p_size AS VARCHAR(9)) || '.a' END"
)


@entry("H3", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'p' || p_size || '_a'
  WHEN 'SMALL' THEN 'p' || p_size || '_d_1' WHEN 'PROMO' THEN 'p' || p_size || '_b'
  ELSE 'p' || p_size || '_a' END AS codigo FROM part""")
def h3(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", H.question_code(F.expr(_CODE)).alias("codigo"))


@entry("H4", """
SELECT p_partkey AS pos, CASE p_type WHEN 'ECONOMY' THEN 'P' || p_size || '_a'
    WHEN 'MEDIUM' THEN 'P' || p_size || '_b_1' WHEN 'SMALL' THEN p_size || '.c'
    WHEN 'STANDARD' THEN p_size || '.d.1' END AS codigo,
  CASE p_type WHEN 'MEDIUM' THEN 'd''' || p_name || ' + ação' WHEN 'STANDARD' THEN p_brand
    WHEN 'LARGE' THEN 'Unnamed: ' || p_size WHEN 'PROMO' THEN p_name || '/' || p_brand
    ELSE p_name END AS enunciado
FROM part""")
def h4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_headers(spark, sf_dir).withColumn("_h", H.split_header(F.col("raw"))).select(
        "pos", F.col("_h.code").alias("codigo"), F.col("_h.statement").alias("enunciado")
    )


_NAME = """CASE p_type WHEN 'ECONOMY' THEN 'p' || p_size || '_a_' || slug
    WHEN 'MEDIUM' THEN 'p' || p_size || '_b_1_d_' || slug || '_mais_acao'
    WHEN 'SMALL' THEN 'p' || p_size || '_c_' || slug
    WHEN 'STANDARD' THEN 'p' || p_size || '_d_1_' || lower(replace(p_brand, '#', '_'))
    WHEN 'LARGE' THEN 'unnamed_' || p_size
    ELSE slug || '_' || lower(replace(p_brand, '#', '_')) END"""
_NAMED = (
    f"(SELECT *, {_NAME} AS name FROM (SELECT *, replace(p_name, ' ', '_') AS slug FROM part))"
)


@entry("H5", f"SELECT p_partkey AS pos, name FROM {_NAMED}")
def h5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_headers(spark, sf_dir).select("pos", H.column_name(F.col("raw")).alias("name"))


@entry("H6", """
SELECT edition, pos, CASE WHEN k = 1 THEN name ELSE name || '_' || k END AS name
FROM (SELECT p_brand AS edition, p_partkey AS pos, replace(p_name, ' ', '_') AS name,
        row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey) AS k FROM part)""")
def h6(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("edition"),
        F.col("p_partkey").alias("pos"),
        H.slugify(F.col("p_name")).alias("name"),
    )
    return unique_names(names).select("edition", "pos", "name")


@entry("H7", f"SELECT p_partkey AS pos, name FROM {_NAMED} WHERE p_type <> 'LARGE'")
def h7(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = raw_headers(spark, sf_dir).select("pos", H.column_name(F.col("raw")).alias("name"))
    return named.where(~H.is_junk(F.col("name")))


# Field patterns made of the tables: one set for each type, one for each name, and three fixed ones.
_PATTERNS_SQL = r"""
SELECT 'tipo_' || lower(p_type) AS field, k AS priority,
  '_' || lower(p_type) || CASE k WHEN 0 THEN '_[1-3]\d$' ELSE '_\d+$' END AS pattern
FROM (SELECT DISTINCT p_type FROM part) CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1)
UNION ALL SELECT DISTINCT 'peca_' || replace(p_name, ' ', '_'), 0, '^' || replace(p_name, ' ', '_') || '_' FROM part
UNION ALL SELECT 'quente', 0, '^hot_' UNION ALL SELECT 'anel', 1, 'ring|gear' UNION ALL SELECT 'anel', 0, '_ring_(economy|promo)_'"""


@entry("H9_text", rf"""
WITH names AS (
  SELECT p_brand AS edition, replace(p_name, ' ', '_') || '_' || lower(p_type) || '_' || p_size AS name FROM part),
patterns AS ({_PATTERNS_SQL})
SELECT edition, field, count(*) AS n, min(priority) AS priority,
  arg_min(name, printf('%02d%04d', priority, length(name)) || name) AS name
FROM names JOIN patterns ON regexp_matches(name, pattern) GROUP BY edition, field""")
def h9_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's description as a header of its brand's edition; patterns from the table choose the fields' best ones."""
    parts = table(spark, sf_dir, "part")
    slug, kind = F.replace("p_name", F.lit(" "), F.lit("_")), F.lower("p_type")
    names = parts.select(F.col("p_brand").alias("edition"), F.concat_ws("_", slug, kind, "p_size").alias("name"))

    def rule(field, priority, pattern):
        return F.struct(field.alias("field"), F.lit(priority).alias("priority"), pattern.alias("pattern"))

    def ends(digits):
        return F.concat(F.lit("_"), kind, F.lit(digits))

    typed = F.concat(F.lit("tipo_"), kind)
    of_part = F.array(
        rule(typed, 0, ends(r"_[1-3]\d$")), rule(typed, 1, ends(r"_\d+$")),
        rule(F.concat(F.lit("peca_"), slug), 0, F.concat(F.lit("^"), slug, F.lit("_"))),
    )
    fixed = [("quente", 0, "^hot_"), ("anel", 1, "ring|gear"), ("anel", 0, "_ring_(economy|promo)_")]
    patterns = parts.select("p_type", "p_name").distinct().select(F.inline(of_part)).distinct().unionByName(
        spark.createDataFrame(fixed, "field string, priority int, pattern string")
    )
    order = F.struct("priority", F.length("name").alias("chars"), "name")
    return match_patterns(names, patterns).groupBy("edition", "field").agg(
        F.count(F.lit(1)).alias("n"), F.min("priority").alias("priority"), F.min(order)["name"].alias("name")
    )
