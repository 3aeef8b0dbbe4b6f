"""The 28 analytic queries: ``query(lake) -> DataFrame``.

Percentages are doubles, editions come from the data, category lists from the lake's vocabulary, and
every query keeps the denominator rule of the table it reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.functions.text import marked_or_zero, percentage, sector_group
from surveylake.operators.compare import (
    editions_side_by_side,
    gap_to_reference,
    in_order,
    premium_vs_first,
    share_within,
)
from surveylake.operators.segments import (
    percentile_columns,
    ratio_of_sums,
    with_percentiles,
)
from surveylake.plans.lake import Lake
from surveylake.plans.marts import ACCURACY, SALARY

MEDIAN = {"salario_mediano": 0.5}


def _year() -> Column:
    return F.col("survey_year").alias("ano")


def _median_by(df: DataFrame, keys: list, count_as: str, *extra) -> DataFrame:
    return with_percentiles(
        df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(count_as),
            percentile_columns(SALARY, MEDIAN, ACCURACY).alias("_sketch"),
            *extra,
        ),
        "_sketch",
        MEDIAN,
    )


def _of_edition(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("survey_year") == year)


def q1_1(lake: Lake) -> DataFrame:
    """Overview of every edition."""
    return lake.mart("gold_evolucao_anual").select(
        _year(), "total_respondentes", "idade_media", "salario_mediano_geral", "pct_mulheres",
        "pct_remoto", "pct_hibrido", "pct_presencial", "pct_usa_ia_generativa",
    ).orderBy("ano")


def q1_2(lake: Lake) -> DataFrame:
    """Job composition, one column per edition."""
    columns = {f"resp_{year}": (year, "respondentes") for year in lake.editions}
    last = lake.last_edition
    profile = lake.mart("gold_perfil_mercado").where(F.col("cargo").isNotNull())
    columns[f"pct_mercado_{last}"] = (last, "pct_do_ano")
    wide = editions_side_by_side(profile, ["cargo"], "survey_year", columns, agg="sum")
    share = f"pct_mercado_{last}"
    return wide.withColumn(share, F.round(share, 2)).orderBy(F.desc(f"resp_{last}"))


def q1_3(lake: Lake) -> DataFrame:
    """Seniority pyramid of each edition."""
    levels = lake.words.query_levels
    counted = (
        lake.silver.where(F.col("senioridade").isin(*levels))
        .groupBy(_year(), "senioridade")
        .agg(F.count(F.lit(1)).alias("respondentes"))
    )
    shared = share_within(counted, "respondentes", ["ano"], "pct_do_ano")
    return in_order(shared, "senioridade", levels, F.col("ano"))


def q1_4(lake: Lake) -> DataFrame:
    """Geographic concentration and median salary."""
    declared = lake.silver.where(F.col("regiao") != lake.words.undeclared)
    counted = _median_by(declared, [_year(), "regiao"], "respondentes")
    return share_within(counted, "respondentes", ["ano"], "pct_do_ano").orderBy(
        "ano", F.desc("respondentes")
    )


def _pay_of(lake: Lake, dimension: str) -> DataFrame:
    return _of_edition(lake.pay(dimension), lake.last_edition).where("amostra_suficiente")


def q2_1(lake: Lake) -> DataFrame:
    """Salary ranking by job with the inter-quartile range."""
    spread = F.round(F.col("salario_p75") - F.col("salario_p25"), 2)
    return _pay_of(lake, "cargo").select(
        F.col("categoria").alias("cargo"), "respondentes", "salario_mediano", "salario_p25",
        "salario_p75", spread.alias("amplitude_interquartil"),
    ).orderBy(F.desc("salario_mediano"))


def q2_2(lake: Lake) -> DataFrame:
    """Seniority premium against the first level with enough respondents."""
    words = lake.words
    paid = lake.silver.where(
        F.col(SALARY).isNotNull() & F.col("senioridade").isin(*words.query_levels)
    )
    levels = _median_by(paid, [_year(), "senioridade"], "_n").where(
        F.col("_n") >= words.min_sample
    )
    premium = premium_vs_first(
        levels, "salario_mediano", ["ano"], "senioridade", words.query_levels,
        "premio_vs_junior_pct",
    ).drop("_n")
    return in_order(premium, "senioridade", words.query_levels, F.col("ano"))


def q2_3(lake: Lake) -> DataFrame:
    """The 20 best-paid job × level segments; ties are broken by job and level."""
    return (
        _of_edition(lake.mart("gold_perfil_mercado"), lake.last_edition)
        .where(F.col("amostra_suficiente") & F.col("salario_mediano").isNotNull())
        .select("cargo", "senioridade", "respondentes", "salario_mediano")
        .orderBy(F.desc("salario_mediano"), "cargo", "senioridade")
        .limit(20)
    )


def q2_4(lake: Lake) -> DataFrame:
    """Return on education."""
    return _pay_of(lake, "nivel_ensino").select(
        F.col("categoria").alias("nivel_ensino"), "respondentes", "salario_mediano"
    ).orderBy(F.desc("salario_mediano"))


def q3_1(lake: Lake) -> DataFrame:
    """Gender share per edition, among respondents with gender and level."""
    counted = (
        lake.mart("gold_diversidade_genero")
        .groupBy(_year(), "genero")
        .agg(F.sum("respondentes").alias("respondentes"))
    )
    return share_within(counted, "respondentes", ["ano"], "pct").orderBy(
        "ano", F.desc("respondentes")
    )


def q3_2(lake: Lake) -> DataFrame:
    """Share of the focus gender by level, one column per edition."""
    words = lake.words
    diversity = lake.mart("gold_diversidade_genero").where(
        F.col("senioridade").isin(*words.query_levels)
    )
    focus = diversity.withColumn(
        "_pct", F.when(F.col("genero") == words.focus_gender, F.col("pct_representatividade"))
    )
    columns = {f"pct_fem_{year}": (year, "_pct") for year in lake.editions}
    wide = editions_side_by_side(focus, ["senioridade"], "survey_year", columns, digits=2)
    return in_order(wide, "senioridade", words.query_levels)


def q3_3(lake: Lake) -> DataFrame:
    """Pay gap at equal level, for the two compared genders."""
    words = lake.words
    return (
        lake.mart("gold_diversidade_genero")
        .where(
            F.col("genero").isin(words.reference_gender, words.focus_gender)
            & F.col("amostra_suficiente")
        )
        .select(
            _year(), "senioridade", "genero", "respondentes", "salario_mediano", "gap_salarial_pct"
        )
        .orderBy("ano", "senioridade", "genero")
    )


def q4_1(lake: Lake) -> DataFrame:
    """Technology ranking of the last edition, by category."""
    return (
        _of_edition(lake.mart("gold_tecnologias"), lake.last_edition)
        .select("categoria", "tecnologia", "usuarios", "base_respondentes", "pct_adocao")
        .orderBy("categoria", F.desc("pct_adocao"))
    )


def q4_2(lake: Lake) -> DataFrame:
    """Risers and fallers between the first and the last edition, in percentage points."""
    first, last = lake.first_edition, lake.last_edition
    before, after = f"pct_{first}", f"pct_{last}"
    wide = editions_side_by_side(
        lake.mart("gold_tecnologias"), ["categoria", "tecnologia"], "survey_year",
        {before: (first, "pct_adocao"), after: (last, "pct_adocao")},
    )
    return (
        wide.where(F.col(before).isNotNull() & F.col(after).isNotNull())
        .withColumn("variacao_pp", F.round(F.col(after) - F.col(before), 2))
        .orderBy(F.desc("variacao_pp"))
    )


def q4_3(lake: Lake) -> DataFrame:
    """Median salary per language, in the last edition that asked for languages."""
    exploded = lake.silver.where(F.col(SALARY).isNotNull()).select(
        "survey_year", SALARY, F.explode("linguagens").alias("linguagem")
    )
    # One row per edition and option of the questionnaire is left for the window.
    counted = _median_by(exploded, ["survey_year", "linguagem"], "profissionais")
    newest = F.max("survey_year").over(Window.partitionBy())
    return (
        counted.withColumn("_newest", newest)
        .where((F.col("survey_year") == F.col("_newest")) & (F.col("profissionais") >= lake.words.min_sample))
        .drop("_newest", "survey_year")
        .orderBy(F.desc("salario_mediano"))
    )


def q4_4(lake: Lake) -> DataFrame:
    """Cloud share over the editions."""
    return (
        lake.mart("gold_tecnologias")
        .where(F.col("categoria") == "Cloud")
        .select(_year(), F.col("tecnologia").alias("provedor_cloud"), "pct_adocao")
        .orderBy("ano", F.desc("pct_adocao"))
    )


def q5_1(lake: Lake) -> DataFrame:
    """AI use of people and priority of companies. The two blocks have separate respondents."""
    people, companies = F.col("pct_usa_ia_generativa"), F.col("pct_empresa_prioriza_ia")
    return (
        lake.mart("gold_evolucao_anual")
        .where(people.isNotNull())
        .select(
            _year(), people.alias("pct_profissionais_usam"),
            companies.alias("pct_empresas_priorizam"),
            F.round(people - companies, 2).alias("lacuna_pp_profissional_vs_empresa"),
        )
        .orderBy("ano")
    )


def q5_2(lake: Lake) -> DataFrame:
    """AI adoption by job in the last edition."""
    rates = ratio_of_sums(
        _of_edition(lake.mart("gold_adocao_ia"), lake.last_edition),
        ["cargo"],
        {
            "pct_uso_pessoal": ("usam_ia", "base_uso_pessoal"),
            "pct_uso_empresa": ("empresas_usam_ia", "base_uso_empresa"),
        },
        sums={"respondentes": "respondentes"},
    )
    return rates.where(F.col("respondentes") >= lake.words.min_sample).orderBy(
        F.desc("pct_uso_pessoal")
    )


def q5_3(lake: Lake) -> DataFrame:
    """Pay with and without AI at equal level."""
    words = lake.words
    answered = _of_edition(lake.silver, lake.last_edition).where(
        F.col("usa_ia_generativa").isNotNull()
        & F.col(SALARY).isNotNull()
        & F.col("senioridade").isin(*words.query_levels)
    )
    return (
        _median_by(answered, ["senioridade", "usa_ia_generativa"], "profissionais")
        .where(F.col("profissionais") >= words.min_sample)
        .orderBy("senioridade", "usa_ia_generativa")
    )


def q5_4(lake: Lake) -> DataFrame:
    """Who pays for AI, share of the edition."""
    counted = (
        lake.silver.where(F.col("tipo_uso_ia").isNotNull())
        .groupBy(_year(), "tipo_uso_ia")
        .agg(F.count(F.lit(1)).alias("respondentes"))
    )
    return share_within(counted, "respondentes", ["ano"], "pct").orderBy(
        "ano", F.desc("respondentes")
    )


def q5_5(lake: Lake) -> DataFrame:
    """Outcome the companies report, last edition."""
    return (
        _of_edition(lake.mart("gold_impacto_ia"), lake.last_edition)
        .select("resultado_ia_empresa", "respondentes", "pct")
        .orderBy(F.desc("respondentes"))
    )


def q6_1(lake: Lake) -> DataFrame:
    """Work models over the editions."""
    return (
        lake.mart("gold_evolucao_anual")
        .select(_year(), "pct_remoto", "pct_hibrido", "pct_presencial")
        .orderBy("ano")
    )


def q6_2(lake: Lake) -> DataFrame:
    """Work model by region, first and last edition side by side."""
    models = lake.mart("gold_modelo_trabalho").where(F.col("regiao") != lake.words.undeclared)
    columns = {
        f"pct_{year}": (year, "pct_na_regiao")
        for year in (lake.first_edition, lake.last_edition)
    }
    return editions_side_by_side(
        models, ["regiao", "modelo_trabalho"], "survey_year", columns, digits=2
    ).orderBy("regiao", "modelo_trabalho")


def q6_3(lake: Lake) -> DataFrame:
    """Median salary by region and work model."""
    return (
        _of_edition(lake.mart("gold_modelo_trabalho"), lake.last_edition)
        .where(F.col("amostra_suficiente") & (F.col("regiao") != lake.words.undeclared))
        .select("regiao", "modelo_trabalho", "respondentes", "salario_mediano")
        .orderBy("regiao", F.desc("salario_mediano"))
    )


def q6_4(lake: Lake) -> DataFrame:
    """Regional cost index at equal level, reference region = 100."""
    words = lake.words
    two = _of_edition(lake.mart("gold_remuneracao_regional"), lake.last_edition).where(
        F.col("regiao").isin(words.compared_region, words.reference_region)
    )
    index = "indice_vs_sudeste_mesma_senioridade"
    indexed = gap_to_reference(
        two, "salario_medio", "regiao", words.reference_region, ["senioridade"], index,
        kind="index", digits=1,
    )
    return indexed.select(
        "regiao", "senioridade", "respondentes", "salario_medio", index, "amostra_suficiente"
    ).orderBy("senioridade", "regiao")


def q7_1(lake: Lake) -> DataFrame:
    """Turnover risk by level."""
    words = lake.words
    asked = _of_edition(lake.silver, lake.last_edition).where(
        F.col("busca_nova_oportunidade").isNotNull()
        & F.col("senioridade").isin(*words.query_levels)
    )
    return (
        asked.groupBy("senioridade")
        .agg(
            F.count(F.lit(1)).alias("respondentes"),
            percentage(
                F.sum(marked_or_zero(F.col("busca_nova_oportunidade"))), F.count(F.lit(1))
            ).alias("pct_buscando"),
        )
        .orderBy(F.desc("pct_buscando"))
    )


def q7_2(lake: Lake) -> DataFrame:
    """Seniors per junior in each job."""
    words = lake.words

    def people(level: str):
        of_level = F.col("senioridade") == level
        return F.sum(F.when(of_level, F.col("respondentes")).otherwise(F.lit(0)))

    counted = (
        _of_edition(lake.mart("gold_perfil_mercado"), lake.last_edition)
        .groupBy("cargo")
        .agg(people(words.junior).alias("juniores"), people(words.senior).alias("seniores"))
        .where(F.col("juniores") + F.col("seniores") >= words.min_sample)
    )
    ratio = F.try_divide(F.col("seniores").cast("double"), F.col("juniores").cast("double"))
    return counted.withColumn("razao_senior_junior", F.round(ratio, 2)).orderBy(
        F.desc("razao_senior_junior")
    )


def q7_3(lake: Lake) -> DataFrame:
    """One sector against the others. Here a missing answer counts as "no", as the query is
    defined; ``rate_among_answered`` gives the rate among those who answered."""
    words = lake.words
    group = sector_group(
        F.col("setor_empresa"), words.sector_words, words.sector_name, words.other_sectors
    ).alias("grupo_setor")

    def share(flag, name: str):
        return F.round(F.avg(marked_or_zero(flag)) * 100, 2).alias(name)

    return _median_by(
        _of_edition(lake.silver, lake.last_edition).where(F.col("setor_empresa").isNotNull()),
        [group],
        "respondentes",
        share(F.col("usa_ia_generativa"), "pct_usa_ia"),
        share(F.col("modelo_trabalho") == words.remote, "pct_remoto"),
    ).orderBy(F.desc("salario_mediano"))


def q7_4(lake: Lake) -> DataFrame:
    """Where a senior costs least: region × job."""
    words = lake.words
    seniors = _of_edition(lake.silver, lake.last_edition).where(
        (F.col("senioridade") == words.senior)
        & F.col(SALARY).isNotNull()
        & (F.col("regiao") != words.undeclared)
    )
    return (
        _median_by(seniors, ["regiao", "cargo"], "disponibilidade")
        .where(F.col("disponibilidade") >= words.min_sample)
        .orderBy("salario_mediano")
    )


QUERIES: dict[str, Callable[[Lake], DataFrame]] = {
    "Q1.1": q1_1, "Q1.2": q1_2, "Q1.3": q1_3, "Q1.4": q1_4,
    "Q2.1": q2_1, "Q2.2": q2_2, "Q2.3": q2_3, "Q2.4": q2_4,
    "Q3.1": q3_1, "Q3.2": q3_2, "Q3.3": q3_3,
    "Q4.1": q4_1, "Q4.2": q4_2, "Q4.3": q4_3, "Q4.4": q4_4,
    "Q5.1": q5_1, "Q5.2": q5_2, "Q5.3": q5_3, "Q5.4": q5_4, "Q5.5": q5_5,
    "Q6.1": q6_1, "Q6.2": q6_2, "Q6.3": q6_3, "Q6.4": q6_4,
    "Q7.1": q7_1, "Q7.2": q7_2, "Q7.3": q7_3, "Q7.4": q7_4,
}
