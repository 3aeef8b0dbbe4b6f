"""Bronze editions → the respondent table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveylake.functions import text as X
from surveylake.functions.rules import CANONICAL_FIELDS, MULTI_SELECT_BLOCKS, SILVER_COLUMNS
from surveylake.operators.harmonise import header_table, resolve_blocks, resolve_fields
from surveylake.operators.ranking import numbered_copies
from surveylake.session import settings
from surveylake.sources.bronze import LINEAGE, bronze_editions, read_edition

LABELLED = {
    "genero": X.gender_label,
    "cargo": X.job_label,
    "senioridade": X.seniority_label,
    "modelo_trabalho": X.work_model_label,
    "tipo_uso_ia": X.ai_usage_label,
    "prioridade_ia_empresa": X.ai_priority_label,
    "resultado_ia_empresa": X.ai_result_label,
}
YES_NO = ("pcd", "gestor", "busca_nova_oportunidade", "empresa_teve_layoff", "possui_data_lake")


@dataclass
class Resolution:
    """Which physical column answers what in one edition."""

    fields: dict[str, str] = field(default_factory=dict)
    options: dict[str, list[tuple[str, str, bool]]] = field(default_factory=dict)


def named_header_table(spark: SparkSession, columns: Mapping[str, list[str]]) -> DataFrame:
    """Header table of Bronze editions, whose columns already carry their final names."""
    kept = {key: [n for n in names if n not in LINEAGE] for key, names in columns.items()}
    return (
        header_table(spark, kept)
        .withColumnRenamed("raw", "name")
        .withColumn("junk", F.lit(False))
    )


def resolve(spark: SparkSession, columns: Mapping[str, list[str]]) -> dict[str, Resolution]:
    """Resolve fields and blocks of all editions in two small jobs. Metadata only."""
    named = named_header_table(spark, columns)
    resolved = {key: Resolution() for key in columns}
    for row in resolve_fields(named).collect():
        resolved[row["edition"]].fields[row["field"]] = row["name"]
    for row in resolve_blocks(named).orderBy("edition", "block", "name").collect():
        resolved[row["edition"]].options.setdefault(row["block"], []).append(
            (row["name"], row["label"], row["technology"])
        )
    return resolved


def canonical_projection(df: DataFrame, resolution: Resolution) -> DataFrame:
    """Cleaned canonical answers plus one array per block; a missing field is a typed NULL."""
    def answer(name: str) -> Column:
        source = resolution.fields.get(name)
        if source is None:
            return F.lit(None).cast("string").alias(name)
        return X.clean_text(F.col(f"`{source}`").cast("string")).alias(name)

    def block(name: str) -> Column:
        options = resolution.options.get(name, [])
        technologies = [(F.col(f"`{c}`"), label) for c, label, is_item in options if is_item]
        if not technologies:
            return F.lit(None).cast("array<string>").alias(name)
        asked = [F.col(f"`{c}`") for c, _, _ in options]
        return X.chosen_labels(technologies, asked).alias(name)

    return df.select(
        *[answer(spec.name) for spec in CANONICAL_FIELDS],
        *[block(spec.name) for spec in MULTI_SELECT_BLOCKS],
    )


def with_respondent_ids(canonical: DataFrame, year: int) -> DataFrame:
    """Give respondents without an id the hash of their answers, and mark them in ``_unnamed``.

    Those who gave the very same answers share a hash; :func:`consolidate` numbers them.
    """
    answers = [c for c in canonical.columns if c != "respondente_id"]
    content = F.concat_ws("_", F.lit(year), F.sha2(F.to_json(F.struct(*answers)), 256))
    return canonical.withColumn("_unnamed", F.col("respondente_id").isNull()).withColumn(
        "respondente_id", F.coalesce("respondente_id", content)
    )


def conform_answers(canonical: DataFrame, year: int) -> DataFrame:
    """Cleaned answers → the respondent table's types and labels."""
    folds = (*LABELLED, "faixa_salarial")
    folded = canonical.withColumns({f"_{name}": X.fold(F.col(name)) for name in folds})
    derived: dict[str, Column] = {
        "idade": X.age_in_years(F.col("idade")),
        "uf_residencia": X.state_code(F.col("uf_residencia")),
        "cargo_original": F.col("cargo"),
        "salario_medio_mensal": X.salary_midpoint(
            F.col("faixa_salarial"), F.col("_faixa_salarial")
        ),
        "usa_ia_generativa": X.uses_ai(F.col("tipo_uso_ia"), F.col("_tipo_uso_ia")),
        "empresa_prioriza_ia": X.company_prioritises_ai(
            F.col("prioridade_ia_empresa"), F.col("_prioridade_ia_empresa")
        ),
        "regiao": X.region_of_state(
            X.state_code(F.col("uf_residencia")), F.col("regiao_declarada")
        ),
    }
    derived.update({name: X.yes_no(F.col(name)) for name in YES_NO})
    derived.update(
        {name: label(F.col(name), F.col(f"_{name}")) for name, label in LABELLED.items()}
    )
    return folded.select(
        F.lit(year).cast("int").alias("survey_year"),
        *[
            derived.get(name, F.col(name)).cast(kind).alias(name)
            for name, kind in SILVER_COLUMNS.items()
        ],
        "_unnamed",
    )


def conform_edition(df: DataFrame, year: int, resolution: Resolution) -> DataFrame:
    """One Bronze edition in the respondent schema, with the mark of :func:`with_respondent_ids`."""
    canonical = canonical_projection(df, resolution)
    return conform_answers(with_respondent_ids(canonical, year), year)


def align(parts: list[DataFrame]) -> list[DataFrame]:
    """Same columns, types and order everywhere; the first part with a column sets its type."""
    types: dict[str, str] = {}
    for part in parts:
        for name, kind in part.dtypes:
            types.setdefault(name, kind)
    return [
        part.select(
            *[
                (F.col(name) if name in part.columns else F.lit(None)).cast(kind).alias(name)
                for name, kind in types.items()
            ]
        )
        for part in parts
    ]


def consolidate(editions: list[DataFrame]) -> DataFrame:
    """All editions with one row per respondent, in one aggregation.

    Rows without an id of their own are equal where their hash is: they are counted, and as many
    rows come out, numbered from 1. The same Bronze rows always yield the same set of ids, nobody is
    lost as a repeat, and a group of equal rows of any size is one row from each map task on its way
    in and comes out of many tasks.
    """
    rows = reduce(DataFrame.unionByName, align(editions))
    keys = ["survey_year", "respondente_id"]
    answers = [c for c in rows.columns if c not in (*keys, "_unnamed")]
    kept = rows.groupBy(*keys).agg(
        F.min(F.struct(*answers)).alias("_first"),
        F.sum(F.col("_unnamed").cast("long")).alias("_equal"),
    )
    copies = kept.withColumn("_times", F.greatest("_equal", F.lit(1)))
    numbered = numbered_copies(copies, "_times", "_nth", keys)
    named = F.when(F.col("_equal") > 0, F.concat_ws("_", "respondente_id", "_nth")).otherwise(F.col("respondente_id"))
    columns = {"respondente_id": named, **{c: F.col(f"_first.{c}") for c in answers}}
    return numbered.select(*[columns.get(c, F.col(c)).alias(c) for c in rows.columns if c != "_unnamed"])


def conform(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The respondent table of every edition in Bronze."""
    editions = {
        year: read_edition(spark, bronze_path, year)
        for year in bronze_editions(spark, bronze_path)
    }
    resolutions = resolve(spark, {str(year): df.columns for year, df in editions.items()})
    return consolidate(
        [conform_edition(df, year, resolutions[str(year)]) for year, df in editions.items()]
    )


def write_silver(silver: DataFrame, silver_path: str) -> int:
    """Write the respondent table by edition; returns the rows written.

    The projection of dozens of derived columns gives the optimizer nothing to infer filters from,
    but makes it spend most of the planning time on trying, so that inference is off here.
    """
    seen = Observation()
    with settings(silver.sparkSession, {"spark.sql.constraintPropagation.enabled": "false"}):
        (
            silver.observe(seen, F.count(F.lit(1)).alias("rows"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("survey_year")
            .parquet(silver_path)
        )
    return seen.get["rows"]


def volume(df: DataFrame) -> DataFrame:
    """Rows per edition."""
    return df.groupBy("survey_year").agg(F.count(F.lit(1)).alias("linhas"))
