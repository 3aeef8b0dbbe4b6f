"""The nine marts built from the respondent table.

Denominators differ on purpose and are stated in each docstring. A mart is a small table; sorting
is left to the writer, so queries over a mart carry no needless range shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.functions.rules import GOLD_COLUMNS, Vocabulary
from surveylake.functions.text import enough, marked, percentage
from surveylake.operators.compare import gap_to_reference, share_within
from surveylake.operators.segments import (
    adoption,
    multi_cut_stats,
    percentile_columns,
    segment_stats,
    with_percentiles,
)

SALARY = "salario_medio_mensal"
ACCURACY = 10_000


def _counted(
    df: DataFrame, keys: list[str], median_as: str = "salario_mediano", *extra: Column
) -> DataFrame:
    """Respondents (with or without salary) and the median of those with one."""
    median = {median_as: 0.5}
    return with_percentiles(
        df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("respondentes"),
            percentile_columns(SALARY, median, ACCURACY).alias("_sketch"),
            *extra,
        ),
        "_sketch",
        median,
    )


def _flagged(df: DataFrame, words: Vocabulary) -> DataFrame:
    return df.withColumn("amostra_suficiente", enough(F.col("respondentes"), words.min_sample))


def market_profile(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Composition by job and level. Base of the share: respondents of the edition with a job."""
    base = silver.where(F.col("cargo").isNotNull())
    mean_age = F.round(F.avg("idade"), 1).alias("idade_media")
    profile = _counted(
        base, ["survey_year", "cargo", "senioridade"], "salario_mediano", mean_age
    )
    return _flagged(share_within(profile, "respondentes", ["survey_year"], "pct_do_ano"), words)


def pay(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Salary statistics for each cut, stacked. Base: respondents with a salary and that cut.

    Salaries are band midpoints, so counting rows per value first leaves a few values per segment
    and map task: exact percentiles cost less here than one sketch per segment.
    """
    cuts = {name: name for name in words.salary_cuts if name in silver.columns}
    return multi_cut_stats(silver, ["survey_year"], cuts, min_n=words.min_sample, exact=True)


def gender_diversity(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Share and pay gap by gender at equal level. Base: respondents with gender and level."""
    base = silver.where(F.col("genero").isNotNull() & F.col("senioridade").isNotNull())
    level = ["survey_year", "senioridade"]
    counted = _counted(base, [*level, "genero"])
    shared = share_within(counted, "respondentes", level, "pct_representatividade")
    compared = gap_to_reference(
        shared,
        "salario_mediano",
        "genero",
        words.reference_gender,
        level,
        "gap_salarial_pct",
        keep_reference_as="salario_mediano_masculino",
    )
    return _flagged(compared, words)


def technologies(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Adoption per technology. Base: respondents of the edition who answered the block."""
    blocks = {
        label: column
        for label, column in words.technology_blocks.items()
        if column in silver.columns
    }
    return adoption(silver, ["survey_year"], blocks)


def ai_adoption(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Personal and company AI use by job and level, NULL segments kept, each on its own base."""
    def answers(flag: str, base: str, yes: str) -> list[Column]:
        return [F.count(flag).alias(base), F.sum(marked(F.col(flag))).alias(yes)]

    counted = silver.groupBy("survey_year", "cargo", "senioridade").agg(
        F.count(F.lit(1)).alias("respondentes"),
        *answers("usa_ia_generativa", "base_uso_pessoal", "usam_ia"),
        *answers("empresa_prioriza_ia", "base_uso_empresa", "empresas_usam_ia"),
    )
    rated = counted.withColumn(
        "pct_uso_pessoal", percentage(F.col("usam_ia"), F.col("base_uso_pessoal"))
    ).withColumn(
        "pct_uso_empresa", percentage(F.col("empresas_usam_ia"), F.col("base_uso_empresa"))
    )
    return _flagged(rated, words)


def ai_impact(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Stage reached with AI. Base: respondents of the edition who answered the question."""
    counted = (
        silver.where(F.col("resultado_ia_empresa").isNotNull())
        .groupBy("survey_year", "resultado_ia_empresa")
        .agg(F.count(F.lit(1)).alias("respondentes"))
    )
    return share_within(counted, "respondentes", ["survey_year"], "pct")


REGIONAL = ["survey_year", "regiao", "senioridade"]


def _with_region_and_level(silver: DataFrame, words: Vocabulary) -> DataFrame:
    return silver.where((F.col("regiao") != words.undeclared) & F.col("senioridade").isNotNull())


def regional_pay(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Salary by region at equal level. Base: respondents with salary, declared region, level."""
    return segment_stats(
        _with_region_and_level(silver, words),
        REGIONAL,
        percentiles={"salario_mediano": 0.5},
        min_n=words.min_sample,
        exact=True,
    )


def regional_means(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """The regional salary mart without its median: counts and means add up in one aggregation."""
    paid = _with_region_and_level(silver, words).where(F.col(SALARY).isNotNull())
    means = paid.groupBy(*REGIONAL).agg(
        F.count(F.lit(1)).alias("respondentes"), F.round(F.avg(SALARY), 2).alias("salario_medio")
    )
    return _flagged(means, words)


def work_model(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Work models by region. Base: respondents with a work model, NULL region its own group."""
    base = silver.where(F.col("modelo_trabalho").isNotNull())
    counted = _counted(base, ["survey_year", "regiao", "modelo_trabalho"])
    shared = share_within(counted, "respondentes", ["survey_year", "regiao"], "pct_na_regiao")
    return _flagged(shared, words)


def yearly_evolution(silver: DataFrame, words: Vocabulary) -> DataFrame:
    """Key figures per edition. Base of each share: those who answered that question."""
    def share(flag: Column, name: str) -> Column:
        return F.round(F.avg(marked(flag)) * 100, 2).alias(name)

    model = F.col("modelo_trabalho")
    median = {"salario_mediano_geral": 0.5}
    return with_percentiles(
        silver.groupBy("survey_year").agg(
            F.count(F.lit(1)).alias("total_respondentes"),
            F.round(F.avg("idade"), 1).alias("idade_media"),
            percentile_columns(SALARY, median, ACCURACY).alias("_sketch"),
            share(F.col("genero") == words.focus_gender, "pct_mulheres"),
            share(model == words.remote, "pct_remoto"),
            share(model == words.hybrid, "pct_hibrido"),
            share(model == words.onsite, "pct_presencial"),
            share(F.col("usa_ia_generativa"), "pct_usa_ia_generativa"),
            share(F.col("empresa_prioriza_ia"), "pct_empresa_prioriza_ia"),
        ),
        "_sketch",
        median,
    )


MARTS: dict[str, Callable[[DataFrame, Vocabulary], DataFrame]] = {
    "gold_perfil_mercado": market_profile,
    "gold_remuneracao": pay,
    "gold_diversidade_genero": gender_diversity,
    "gold_tecnologias": technologies,
    "gold_adocao_ia": ai_adoption,
    "gold_impacto_ia": ai_impact,
    "gold_remuneracao_regional": regional_pay,
    "gold_modelo_trabalho": work_model,
    "gold_evolucao_anual": yearly_evolution,
}

MART_ORDER: dict[str, list[Column | str]] = {
    "gold_perfil_mercado": ["survey_year", "-respondentes"],
    "gold_remuneracao": ["survey_year", "dimensao", "-salario_mediano"],
    "gold_diversidade_genero": ["survey_year", "senioridade", "-respondentes"],
    "gold_tecnologias": ["survey_year", "categoria", "-pct_adocao"],
    "gold_adocao_ia": ["survey_year", "-respondentes"],
    "gold_impacto_ia": ["survey_year", "-respondentes"],
    "gold_remuneracao_regional": ["survey_year", "regiao", "senioridade"],
    "gold_modelo_trabalho": ["survey_year", "regiao", "-respondentes"],
    "gold_evolucao_anual": ["survey_year"],
}


def build_mart(name: str, silver: DataFrame, words: Vocabulary = Vocabulary()) -> DataFrame:
    """One mart with the column order of its contract."""
    return MARTS[name](silver, words).select(*GOLD_COLUMNS[name])
