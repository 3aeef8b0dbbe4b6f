"""The data frames behind the charts and the headline figures: ``frame(lake) -> DataFrame``.

Only data is produced here; drawing is left to the reader's tool. Every frame is a composition
over the marts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.functions.text import edition_label, marked, percentage
from surveylake.operators.compare import (
    premium_vs_first,
    reindex,
    relative_to,
    share_within,
    top_k,
)
from surveylake.plans.lake import Lake


def _last(lake: Lake, mart: str) -> DataFrame:
    return lake.mart(mart).where(F.col("survey_year") == lake.newest)


def _reliable_pay(lake: Lake, dimension: str) -> DataFrame:
    return lake.pay(dimension).where("amostra_suficiente")


def p1_job_composition(lake: Lake) -> DataFrame:
    """Jobs of the last edition with enough people; shares of the total kept."""
    jobs = (
        _last(lake, "gold_perfil_mercado")
        .where(F.col("cargo").isNotNull())
        .groupBy("survey_year", "cargo")
        .agg(F.sum("respondentes").alias("respondentes"))
        .where(F.col("respondentes") >= lake.words.min_sample)
    )
    # Jobs may be free text: the total is an aggregate of its own, not a window over all of them.
    total = jobs.groupBy("survey_year").agg(F.sum("respondentes").alias("_total"))
    return jobs.join(total, "survey_year").select(
        "cargo", "respondentes", percentage(F.col("respondentes"), F.col("_total")).alias("pct")
    )


def p2_seniority_pyramid(lake: Lake) -> DataFrame:
    """Edition × level, each row adding up to 100; an absent level is zero."""
    levels = lake.words.seniority_order
    wide = (
        lake.mart("gold_perfil_mercado")
        .where(F.col("senioridade").isin(*levels))
        .groupBy("survey_year")
        .pivot("senioridade", list(levels))
        .agg(F.sum("respondentes"))
        .na.fill(0)
    )
    total = reduce(lambda a, b: a + b, [F.col(f"`{level}`") for level in levels])
    return wide.select(
        "survey_year", *[percentage(F.col(f"`{level}`"), total).alias(level) for level in levels]
    )


def p3_salary_multiple(lake: Lake) -> DataFrame:
    """Median of each level of the last edition as a multiple of the first level present."""
    words = lake.words
    levels = _reliable_pay(lake, "senioridade").where(
        (F.col("survey_year") == lake.last_edition)
        & F.col("categoria").isin(*words.seniority_order)
    )
    return premium_vs_first(
        levels, "salario_mediano", ["survey_year"], "categoria", words.seniority_order,
        "multiplo", kind="ratio", digits=4,
    ).select("categoria", "salario_mediano", "multiplo")


def p4_quartiles_by_job(lake: Lake) -> DataFrame:
    """Median and quartiles per job, without the catch-all job."""
    words = lake.words
    return (
        _reliable_pay(lake, "cargo")
        .where(
            (F.col("survey_year") == lake.last_edition)
            & (F.col("categoria") != words.other_job)
        )
        .select("categoria", "respondentes", "salario_p25", "salario_mediano", "salario_p75")
    )


def p5_focus_gender_share(lake: Lake) -> DataFrame:
    return lake.mart("gold_evolucao_anual").select("survey_year", "pct_mulheres")


def p6_gap_by_level(lake: Lake) -> DataFrame:
    """Pay gap of the focus gender by level, with its direction."""
    words = lake.words
    gap = F.col("gap_salarial_pct")
    direction = (
        F.when(F.abs(gap) < 0.5, F.lit("sem diferença"))
        .when(gap < 0, F.lit("negativo"))
        .otherwise(F.lit("positivo"))
    )
    return (
        _last(lake, "gold_diversidade_genero")
        .where(
            (F.col("genero") == words.focus_gender)
            & F.col("amostra_suficiente")
            & F.col("senioridade").isin(*words.seniority_order)
        )
        .select("senioridade", "gap_salarial_pct", direction.alias("classe"))
    )


def p7_top_technologies(lake: Lake, k: int = 7) -> DataFrame:
    """Top technologies per category in the last edition that asked for the category."""
    return top_k(
        lake.mart("gold_tecnologias"), ["categoria"],
        [F.desc("pct_adocao"), F.asc("tecnologia")], k, latest_of="survey_year",
    ).withColumn("edicao", edition_label(F.col("survey_year")))


def p8_ai_adoption_series(lake: Lake) -> DataFrame:
    """Both AI series with the respondents of each block and their contrast in points, in one pass."""
    def block(flag: str, base: str, rate: str) -> list[Column]:
        return [F.count(flag).alias(base), F.round(F.avg(marked(F.col(flag))) * 100, 2).alias(rate)]

    people, companies = F.col("pct_usa_ia_generativa"), F.col("pct_empresa_prioriza_ia")
    return (
        lake.silver.groupBy("survey_year")
        .agg(
            *block("usa_ia_generativa", "n_pessoal", "pct_usa_ia_generativa"),
            *block("empresa_prioriza_ia", "n_empresa", "pct_empresa_prioriza_ia"),
        )
        .withColumn("contraste_pp", F.round(people - companies, 2))
    )


def p9_work_model_series(lake: Lake) -> DataFrame:
    """Work-model shares per edition, one row per model."""
    words = lake.words
    models = {
        words.onsite: "pct_presencial", words.hybrid: "pct_hibrido", words.remote: "pct_remoto"
    }
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("modelo_trabalho"), F.col(column).alias("pct"))
            for name, column in models.items()
        ]
    )
    return lake.mart("gold_evolucao_anual").select("survey_year", F.inline(rows))


def p10_two_regions(lake: Lake) -> DataFrame:
    """Mean salary of the two compared regions by level; reliable only if both sides are."""
    words = lake.words
    sides = {"comparada": words.compared_region, "referencia": words.reference_region}

    def side(region: str, column: str) -> Column:
        return F.max(F.when(F.col("regiao") == region, F.col(column)))

    aggregates = []
    for name, region in sides.items():
        aggregates += [
            side(region, "salario_medio").alias(f"salario_{name}"),
            side(region, "respondentes").alias(f"n_{name}"),
        ]
    compared, reference = F.col("salario_comparada"), F.col("salario_referencia")
    both = F.coalesce(
        (F.col("n_comparada") >= words.min_sample) & (F.col("n_referencia") >= words.min_sample),
        F.lit(False),
    )
    return (
        _last(lake, "gold_remuneracao_regional")
        .where(
            F.col("regiao").isin(*sides.values())
            & F.col("senioridade").isin(*words.seniority_order)
        )
        .groupBy("senioridade")
        .agg(*aggregates)
        .withColumn("diferenca_pct", relative_to(compared, reference))
        .withColumn("confiavel", both)
    )


def p11_level_medians(lake: Lake) -> DataFrame:
    """Median of each level over the editions, with the last point of its line."""
    series = _reliable_pay(lake, "senioridade").where(
        F.col("categoria").isin(*lake.words.seniority_order)
    )
    points = F.array_sort(F.collect_list(F.struct("survey_year", "salario_mediano")))
    last = F.max_by(F.struct("survey_year", "salario_mediano"), F.col("survey_year"))
    # One point per (level, edition): the list is as long as the survey has editions.
    lines = series.groupBy("categoria").agg(points.alias("_points"), last.alias("_last"))
    return lines.select(
        "categoria",
        F.col("_last.survey_year").alias("ultima_edicao"),
        F.col("_last.salario_mediano").alias("ultimo_salario"),
        F.inline("_points"),
    )


def p12_outcome_funnel(lake: Lake) -> DataFrame:
    """Stages in maturity order for the latest edition with the question; none is left out."""
    # One row per edition and stage of the question is left for the window.
    newest = F.max("survey_year").over(Window.partitionBy())
    current = lake.mart("gold_impacto_ia").withColumn("_newest", newest)
    current = current.where(F.col("survey_year") == F.col("_newest")).drop("_newest")
    return reindex(current, "resultado_ia_empresa", lake.words.result_stages)


def k1_headline_figures(lake: Lake) -> DataFrame:
    """One row with every headline figure, each taken from the mart that defines it."""
    words = lake.words

    def last(column: str, name: str) -> Column:
        return F.max_by(column, "survey_year").alias(name)

    def first(column: str, name: str) -> Column:
        return F.min_by(column, "survey_year").alias(name)

    def one_row(df: DataFrame, *columns: Column) -> DataFrame:
        return df.groupBy().agg(*columns)

    evolution = one_row(
        lake.mart("gold_evolucao_anual"),
        F.sum("total_respondentes").alias("total_respondentes"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("survey_year", "total_respondentes"))),
                lambda e: F.concat_ws(":", e["survey_year"], e["total_respondentes"]),
            ),
            ",",
        ).alias("respondentes_por_edicao"),
        last("pct_usa_ia_generativa", "pct_ia_ultimo"),
        first("pct_usa_ia_generativa", "pct_ia_primeiro"),
        last("pct_empresa_prioriza_ia", "pct_empresa_ia_ultimo"),
        first("pct_mulheres", "pct_mulheres_primeiro"),
        last("pct_mulheres", "pct_mulheres_ultimo"),
        first("pct_remoto", "pct_remoto_primeiro"),
        last("pct_remoto", "pct_remoto_ultimo"),
        first("pct_presencial", "pct_presencial_primeiro"),
        last("pct_presencial", "pct_presencial_ultimo"),
    )
    blocks = one_row(
        _last(lake, "gold_adocao_ia"),
        F.sum("base_uso_pessoal").alias("base_uso_pessoal_ia"),
        F.sum("base_uso_empresa").alias("base_uso_empresa_ia"),
    )

    cuts = ("senioridade", "cargo", "regiao")
    pay = lake.pay(*cuts).where((F.col("survey_year") == lake.newest) & F.col("amostra_suficiente"))

    def of(dimension: str, value: Column) -> Column:
        return F.when(F.col("dimensao") == dimension, value)

    def level(name: str) -> Column:
        return F.max(F.when(F.col("categoria") == name, of("senioridade", F.col("salario_mediano"))))

    job = F.when(F.col("categoria") != words.other_job, of("cargo", F.struct("salario_mediano", "categoria")))
    region = of("regiao", F.struct("salario_medio", "categoria"))
    salaries = one_row(
        pay,
        level(words.junior).alias("sal_junior"),
        level(words.senior).alias("sal_senior"),
        level(words.specialist).alias("sal_especialista"),
        F.max(job).getField("categoria").alias("cargo_topo"),
        F.max(job).getField("salario_mediano").alias("cargo_topo_sal"),
        F.max(region).getField("categoria").alias("regiao_cara"),
        F.max(region).getField("salario_medio").alias("regiao_cara_sal"),
        F.min(region).getField("categoria").alias("regiao_barata"),
        F.min(region).getField("salario_medio").alias("regiao_barata_sal"),
    )
    volume = (
        _last(lake, "gold_perfil_mercado")
        .where(F.col("cargo").isNotNull())
        .groupBy("cargo")
        .agg(F.sum("respondentes").alias("n"))
    )
    biggest = one_row(
        volume,
        F.max_by("cargo", F.struct("n", "cargo")).alias("cargo_maior_volume"),
        F.max("n").alias("cargo_maior_volume_n"),
    )

    def mean_of(region: str, seniority: str) -> Column:
        hit = (F.col("regiao") == region) & (F.col("senioridade") == seniority)
        return F.max(F.when(hit, F.col("salario_medio")))

    def discount(seniority: str, name: str) -> Column:
        gap = relative_to(
            mean_of(words.compared_region, seniority), mean_of(words.reference_region, seniority)
        )
        return (-gap).alias(name)

    regional = one_row(
        lake.regional_means().where((F.col("survey_year") == lake.newest) & F.col("amostra_suficiente")),
        discount(words.junior, "desconto_regional_junior"),
        discount(words.senior, "desconto_regional_senior"),
    )
    gap = one_row(
        _last(lake, "gold_diversidade_genero").where(
            (F.col("genero") == words.focus_gender) & (F.col("senioridade") == words.senior)
        ),
        F.max("gap_salarial_pct").alias("gap_senior"),
    )

    def leader(category: str) -> Column:
        # Latest edition first, then adoption; the name decides ties.
        return F.max(F.when(F.col("categoria") == category, F.struct("survey_year", "pct_adocao", "tecnologia")))

    leaders = one_row(
        lake.mart("gold_tecnologias"),
        *[
            leader(category).getField(value).alias(f"top_{column}{suffix}")
            for category, column in words.technology_blocks.items()
            for value, suffix in (("tecnologia", ""), ("pct_adocao", "_pct"))
        ],
    )

    def stage(name: str) -> Column:
        return F.max(F.when(F.col("resultado_ia_empresa") == name, F.col("pct")))

    per_edition = (
        lake.mart("gold_impacto_ia")
        .groupBy("survey_year")
        .agg(
            stage(words.stage_in_production).alias("pct_ia_producao"),
            stage(words.stage_pilot).alias("pct_ia_piloto"),
            F.sum("respondentes").alias("base_impacto_ia"),
        )
    )
    newest = F.max_by(
        F.struct("pct_ia_producao", "pct_ia_piloto", "base_impacto_ia"), F.col("survey_year")
    )
    impact = per_edition.groupBy().agg(newest.alias("_newest")).select("_newest.*")

    parts = [evolution, blocks, salaries, biggest, regional, gap, leaders, impact]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    row = stacked.groupBy().agg(*[F.max(column).alias(column) for column in stacked.columns])
    cheap, dear = F.col("regiao_barata_sal"), F.col("regiao_cara_sal")
    return row.withColumns(
        {
            "lacuna_ia": F.round(F.col("pct_ia_ultimo") - F.col("pct_empresa_ia_ultimo"), 2),
            "multiplo_senior": relative_to(F.col("sal_senior"), F.col("sal_junior"), "ratio", 4),
            "desconto_regional_bruto": -relative_to(cheap, dear),
        }
    )


FRAMES: dict[str, Callable[[Lake], DataFrame]] = {
    "P1": p1_job_composition,
    "P2": p2_seniority_pyramid,
    "P3": p3_salary_multiple,
    "P4": p4_quartiles_by_job,
    "P5": p5_focus_gender_share,
    "P6": p6_gap_by_level,
    "P7": p7_top_technologies,
    "P8": p8_ai_adoption_series,
    "P9": p9_work_model_series,
    "P10": p10_two_regions,
    "P11": p11_level_medians,
    "P12": p12_outcome_funnel,
    "K1": k1_headline_figures,
}
