"""Marts, analytic queries and presentation frames over the bound respondent table."""

from __future__ import annotations

from surveylake.bindings.registry import Registry
from surveylake.bindings.tables import WORDS, lake, with_silver
from surveylake.plans.analytics import QUERIES
from surveylake.plans.frames import FRAMES

REGISTRY = Registry()

SHARE = "round({part} * 100.0 / sum({part}) OVER (PARTITION BY {by}), 2)"
MEDIAN = "quantile_disc(salario_medio_mensal, 0.5)"

_CUTS = "\n  UNION ALL ".join(
    f"SELECT survey_year, '{cut}' AS dimensao, {cut} AS categoria, salario_medio_mensal FROM silver"
    for cut in WORDS.salary_cuts
)

_BLOCKS = "\n  UNION ALL ".join(
    f"""SELECT i.survey_year, '{label}' AS categoria, i.tecnologia, i.usuarios, b.base_respondentes
  FROM (SELECT survey_year, tecnologia, count(*) AS usuarios
        FROM (SELECT survey_year, unnest({column}) AS tecnologia FROM silver)
        GROUP BY survey_year, tecnologia) i
  JOIN (SELECT survey_year, count(*) AS base_respondentes FROM silver
        WHERE {column} IS NOT NULL GROUP BY survey_year) b ON i.survey_year = b.survey_year"""
    for label, column in WORDS.technology_blocks.items()
)

MART_SQL = {
    "gold_perfil_mercado": f"""
  SELECT *, {SHARE.format(part='respondentes', by='survey_year')} AS pct_do_ano,
         respondentes >= 30 AS amostra_suficiente
  FROM (SELECT survey_year, cargo, senioridade, count(*) AS respondentes,
               round(avg(idade), 1) AS idade_media, {MEDIAN} AS salario_mediano
        FROM silver WHERE cargo IS NOT NULL GROUP BY survey_year, cargo, senioridade)""",
    "gold_remuneracao": f"""
  SELECT survey_year, dimensao, categoria, count(*) AS respondentes,
         round(avg(salario_medio_mensal), 2) AS salario_medio,
         {MEDIAN} AS salario_mediano,
         quantile_disc(salario_medio_mensal, 0.25) AS salario_p25,
         quantile_disc(salario_medio_mensal, 0.75) AS salario_p75,
         count(*) >= 30 AS amostra_suficiente
  FROM ({_CUTS})
  WHERE categoria IS NOT NULL AND salario_medio_mensal IS NOT NULL
  GROUP BY survey_year, dimensao, categoria""",
    "gold_diversidade_genero": f"""
  SELECT *, round((salario_mediano - salario_mediano_masculino) * 100.0
                  / salario_mediano_masculino, 2) AS gap_salarial_pct
  FROM (SELECT *, {SHARE.format(part='respondentes', by='survey_year, senioridade')}
                    AS pct_representatividade,
               max(CASE WHEN genero = 'P' THEN salario_mediano END)
                 OVER (PARTITION BY survey_year, senioridade) AS salario_mediano_masculino,
               respondentes >= 30 AS amostra_suficiente
        FROM (SELECT survey_year, senioridade, genero, count(*) AS respondentes,
                     {MEDIAN} AS salario_mediano
              FROM silver WHERE genero IS NOT NULL AND senioridade IS NOT NULL
              GROUP BY survey_year, senioridade, genero))""",
    "gold_tecnologias": f"""
  SELECT *, round(usuarios * 100.0 / base_respondentes, 2) AS pct_adocao
  FROM ({_BLOCKS})""",
    "gold_adocao_ia": """
  SELECT *, round(usam_ia * 100.0 / nullif(base_uso_pessoal, 0), 2) AS pct_uso_pessoal,
         round(empresas_usam_ia * 100.0 / nullif(base_uso_empresa, 0), 2) AS pct_uso_empresa,
         respondentes >= 30 AS amostra_suficiente
  FROM (SELECT survey_year, cargo, senioridade, count(*) AS respondentes,
               count(usa_ia_generativa) AS base_uso_pessoal,
               CAST(sum(CAST(usa_ia_generativa AS INTEGER)) AS BIGINT) AS usam_ia,
               count(empresa_prioriza_ia) AS base_uso_empresa,
               CAST(sum(CAST(empresa_prioriza_ia AS INTEGER)) AS BIGINT) AS empresas_usam_ia
        FROM silver GROUP BY survey_year, cargo, senioridade)""",
    "gold_impacto_ia": f"""
  SELECT *, {SHARE.format(part='respondentes', by='survey_year')} AS pct
  FROM (SELECT survey_year, resultado_ia_empresa, count(*) AS respondentes FROM silver
        WHERE resultado_ia_empresa IS NOT NULL GROUP BY survey_year, resultado_ia_empresa)""",
    "gold_remuneracao_regional": f"""
  SELECT survey_year, regiao, senioridade, count(*) AS respondentes,
         round(avg(salario_medio_mensal), 2) AS salario_medio, {MEDIAN} AS salario_mediano,
         count(*) >= 30 AS amostra_suficiente
  FROM silver
  WHERE salario_medio_mensal IS NOT NULL AND regiao <> 'UNDECLARED' AND senioridade IS NOT NULL
  GROUP BY survey_year, regiao, senioridade""",
    "gold_modelo_trabalho": f"""
  SELECT *, {SHARE.format(part='respondentes', by='survey_year, regiao')} AS pct_na_regiao,
         respondentes >= 30 AS amostra_suficiente
  FROM (SELECT survey_year, regiao, modelo_trabalho, count(*) AS respondentes,
               {MEDIAN} AS salario_mediano
        FROM silver WHERE modelo_trabalho IS NOT NULL
        GROUP BY survey_year, regiao, modelo_trabalho)""",
    "gold_evolucao_anual": f"""
  SELECT survey_year, count(*) AS total_respondentes, round(avg(idade), 1) AS idade_media,
         {MEDIAN} AS salario_mediano_geral,
         round(avg(CAST(genero = 'F' AS INTEGER)) * 100, 2) AS pct_mulheres,
         round(avg(CAST(modelo_trabalho = 'R' AS INTEGER)) * 100, 2) AS pct_remoto,
         round(avg(CAST(modelo_trabalho = 'N' AS INTEGER)) * 100, 2) AS pct_hibrido,
         round(avg(CAST(modelo_trabalho = 'A' AS INTEGER)) * 100, 2) AS pct_presencial,
         round(avg(CAST(usa_ia_generativa AS INTEGER)) * 100, 2) AS pct_usa_ia_generativa,
         round(avg(CAST(empresa_prioriza_ia AS INTEGER)) * 100, 2) AS pct_empresa_prioriza_ia
  FROM silver GROUP BY survey_year""",
}

MART_KEYS = {
    "G1": "gold_perfil_mercado",
    "G2": "gold_remuneracao",
    "G3": "gold_diversidade_genero",
    "G4": "gold_tecnologias",
    "G5": "gold_adocao_ia",
    "G6": "gold_impacto_ia",
    "G7": "gold_remuneracao_regional",
    "G8": "gold_modelo_trabalho",
    "G9": "gold_evolucao_anual",
}


def with_marts(select: str, *extra: str) -> str:
    """Oracle text over the marts that ``select`` or the extra tables name."""
    text = select + " ".join(extra)
    used = [f"{name} AS ({sql})" for name, sql in MART_SQL.items() if name in text]
    return with_silver(select, *used, *extra)


# Editions of the orders; the queries find them in the data.
YEARS = range(1995, 2002)
LEVEL_IN = "senioridade IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '0-LEAD')"
SHARE_OF_YEAR = "round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY survey_year), 2)"

QUERY_SQL = {
    "Q1.1": """SELECT survey_year AS ano, total_respondentes, idade_media, salario_mediano_geral,
  pct_mulheres, pct_remoto, pct_hibrido, pct_presencial, pct_usa_ia_generativa
FROM gold_evolucao_anual""",
    "Q1.2": "SELECT cargo, " + ", ".join(
        f"CAST(coalesce(sum(respondentes) FILTER (survey_year = {year}), 0) AS BIGINT) AS resp_{year}" for year in YEARS
    ) + f""",
  round(coalesce(sum(pct_do_ano) FILTER (survey_year = (SELECT max(survey_year) FROM silver)), 0), 2)
    AS pct_mercado_{YEARS[-1]}
FROM gold_perfil_mercado WHERE cargo IS NOT NULL GROUP BY cargo""",
    "Q1.3": f"""SELECT survey_year AS ano, senioridade, count(*) AS respondentes,
  {SHARE_OF_YEAR} AS pct_do_ano
FROM silver WHERE {LEVEL_IN} GROUP BY survey_year, senioridade""",
    "Q1.4": f"""SELECT survey_year AS ano, regiao, count(*) AS respondentes,
  {SHARE_OF_YEAR} AS pct_do_ano, {MEDIAN} AS salario_mediano
FROM silver WHERE regiao IS NOT NULL AND regiao <> 'UNDECLARED' GROUP BY survey_year, regiao""",
    "Q2.1": """SELECT categoria AS cargo, respondentes, salario_mediano, salario_p25, salario_p75,
  round(salario_p75 - salario_p25, 2) AS amplitude_interquartil
FROM gold_remuneracao WHERE dimensao = 'cargo' AND survey_year = (SELECT max(survey_year) FROM silver) AND amostra_suficiente""",
    "Q2.2": f"""SELECT survey_year AS ano, senioridade, round(mediana, 2) AS salario_mediano,
  round(100.0 * (mediana - first_value(mediana) OVER w) / first_value(mediana) OVER w, 1)
    AS premio_vs_junior_pct
FROM (SELECT survey_year, senioridade, {MEDIAN} AS mediana FROM silver
      WHERE salario_medio_mensal IS NOT NULL AND {LEVEL_IN}
      GROUP BY survey_year, senioridade HAVING count(*) >= 30)
WINDOW w AS (PARTITION BY survey_year ORDER BY CASE senioridade WHEN '1-URGENT' THEN 1
             WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END)""",
    "Q2.3": """SELECT cargo, senioridade, respondentes, salario_mediano FROM gold_perfil_mercado
WHERE survey_year = (SELECT max(survey_year) FROM silver) AND amostra_suficiente AND salario_mediano IS NOT NULL
ORDER BY salario_mediano DESC, cargo, senioridade NULLS FIRST LIMIT 20""",
    "Q2.4": """SELECT categoria AS nivel_ensino, respondentes, salario_mediano
FROM gold_remuneracao
WHERE dimensao = 'nivel_ensino' AND survey_year = (SELECT max(survey_year) FROM silver) AND amostra_suficiente""",
    "Q3.1": """SELECT survey_year AS ano, genero, CAST(sum(respondentes) AS BIGINT) AS respondentes,
  round(100.0 * sum(respondentes) / sum(sum(respondentes)) OVER (PARTITION BY survey_year), 2)
    AS pct
FROM gold_diversidade_genero GROUP BY survey_year, genero""",
    "Q3.2": "SELECT senioridade, " + ", ".join(
        f"round(max(pct_representatividade) FILTER (survey_year = {year} AND genero = 'F'), 2) AS pct_fem_{year}" for year in YEARS
    ) + f"""
FROM gold_diversidade_genero WHERE {LEVEL_IN} GROUP BY senioridade""",
    "Q3.3": """SELECT survey_year AS ano, senioridade, genero, respondentes, salario_mediano,
  gap_salarial_pct
FROM gold_diversidade_genero WHERE genero IN ('P', 'F') AND amostra_suficiente""",
    "Q4.1": """SELECT categoria, tecnologia, usuarios, base_respondentes, pct_adocao
FROM gold_tecnologias WHERE survey_year = (SELECT max(survey_year) FROM silver)""",
    "Q4.2": f"""SELECT categoria, tecnologia, a.pct_adocao AS pct_{YEARS[0]}, z.pct_adocao AS pct_{YEARS[-1]},
  round(z.pct_adocao - a.pct_adocao, 2) AS variacao_pp
FROM gold_tecnologias a JOIN gold_tecnologias z USING (categoria, tecnologia)
WHERE a.survey_year = (SELECT min(survey_year) FROM silver)
  AND z.survey_year = (SELECT max(survey_year) FROM silver)""",
    "Q4.3": f"""SELECT linguagem, count(*) AS profissionais, {MEDIAN} AS salario_mediano
FROM (SELECT salario_medio_mensal, unnest(linguagens) AS linguagem FROM silver
      WHERE survey_year = (SELECT max(survey_year) FROM silver WHERE linguagens IS NOT NULL)
        AND salario_medio_mensal IS NOT NULL)
GROUP BY linguagem HAVING count(*) >= 30""",
    "Q4.4": """SELECT survey_year AS ano, tecnologia AS provedor_cloud, pct_adocao
FROM gold_tecnologias WHERE categoria = 'Cloud'""",
    "Q5.1": """SELECT survey_year AS ano, pct_usa_ia_generativa AS pct_profissionais_usam,
  pct_empresa_prioriza_ia AS pct_empresas_priorizam,
  round(pct_usa_ia_generativa - pct_empresa_prioriza_ia, 2)
    AS lacuna_pp_profissional_vs_empresa
FROM gold_evolucao_anual WHERE pct_usa_ia_generativa IS NOT NULL""",
    "Q5.2": """SELECT cargo, count(*) AS respondentes,
  round(avg(CAST(usa_ia_generativa AS INTEGER)) * 100, 2) AS pct_uso_pessoal,
  round(avg(CAST(empresa_prioriza_ia AS INTEGER)) * 100, 2) AS pct_uso_empresa
FROM silver WHERE survey_year = (SELECT max(survey_year) FROM silver)
GROUP BY cargo HAVING count(*) >= 30""",
    "Q5.3": f"""SELECT senioridade, usa_ia_generativa, count(*) AS profissionais,
  {MEDIAN} AS salario_mediano
FROM silver
WHERE survey_year = (SELECT max(survey_year) FROM silver) AND usa_ia_generativa IS NOT NULL
  AND salario_medio_mensal IS NOT NULL AND {LEVEL_IN}
GROUP BY senioridade, usa_ia_generativa HAVING count(*) >= 30""",
    "Q5.4": f"""SELECT survey_year AS ano, tipo_uso_ia, count(*) AS respondentes,
  {SHARE_OF_YEAR} AS pct
FROM silver WHERE tipo_uso_ia IS NOT NULL GROUP BY survey_year, tipo_uso_ia""",
    "Q5.5": """SELECT resultado_ia_empresa, respondentes, pct FROM gold_impacto_ia
WHERE survey_year = (SELECT max(survey_year) FROM silver)""",
    "Q6.1": """SELECT survey_year AS ano, pct_remoto, pct_hibrido, pct_presencial
FROM gold_evolucao_anual""",
    "Q6.2": f"""SELECT regiao, modelo_trabalho,
  round(max(pct_na_regiao) FILTER (survey_year = (SELECT min(survey_year) FROM silver)), 2) AS pct_{YEARS[0]},
  round(max(pct_na_regiao) FILTER (survey_year = (SELECT max(survey_year) FROM silver)), 2) AS pct_{YEARS[-1]}
FROM gold_modelo_trabalho WHERE regiao <> 'UNDECLARED' GROUP BY regiao, modelo_trabalho""",
    "Q6.3": """SELECT regiao, modelo_trabalho, respondentes, salario_mediano
FROM gold_modelo_trabalho
WHERE survey_year = (SELECT max(survey_year) FROM silver) AND amostra_suficiente AND regiao <> 'UNDECLARED'""",
    "Q6.4": """SELECT m.regiao, m.senioridade, m.respondentes, m.salario_medio,
  round(100.0 * m.salario_medio / e.salario_medio, 1) AS indice_vs_sudeste_mesma_senioridade, m.amostra_suficiente
FROM gold_remuneracao_regional m LEFT JOIN gold_remuneracao_regional e
  ON e.regiao = 'EUROPE' AND e.senioridade = m.senioridade AND e.survey_year = m.survey_year
WHERE m.survey_year = (SELECT max(survey_year) FROM silver) AND m.regiao IN ('AFRICA', 'EUROPE')""",
    "Q7.1": f"""SELECT senioridade, count(*) AS respondentes,
  round(100.0 * sum(CASE WHEN busca_nova_oportunidade THEN 1 ELSE 0 END) / count(*), 2)
    AS pct_buscando
FROM silver WHERE survey_year = (SELECT max(survey_year) FROM silver) AND busca_nova_oportunidade IS NOT NULL AND {LEVEL_IN}
GROUP BY senioridade""",
    "Q7.2": """SELECT cargo, count(*) FILTER (senioridade = '1-URGENT') AS juniores,
  count(*) FILTER (senioridade = '3-MEDIUM') AS seniores,
  round(1.0 * count(*) FILTER (senioridade = '3-MEDIUM')
        / nullif(count(*) FILTER (senioridade = '1-URGENT'), 0), 2) AS razao_senior_junior
FROM silver WHERE survey_year = (SELECT max(survey_year) FROM silver) AND cargo IS NOT NULL
GROUP BY cargo HAVING count(*) FILTER (senioridade IN ('1-URGENT', '3-MEDIUM')) >= 30""",
    "Q7.3": f"""SELECT CASE WHEN lower(setor_empresa) LIKE '%build%'
       OR lower(setor_empresa) LIKE '%auto%' THEN 'CONSTRUCTION' ELSE 'OTHER' END AS grupo_setor,
  count(*) AS respondentes, {MEDIAN} AS salario_mediano,
  round(100.0 * avg(CASE WHEN usa_ia_generativa THEN 1.0 ELSE 0.0 END), 2) AS pct_usa_ia,
  round(100.0 * avg(CASE WHEN modelo_trabalho = 'R' THEN 1.0 ELSE 0.0 END), 2) AS pct_remoto
FROM silver WHERE survey_year = (SELECT max(survey_year) FROM silver) AND setor_empresa IS NOT NULL GROUP BY 1""",
    "Q7.4": f"""SELECT regiao, cargo, count(*) AS disponibilidade, {MEDIAN} AS salario_mediano
FROM silver
WHERE survey_year = (SELECT max(survey_year) FROM silver) AND senioridade = '3-MEDIUM' AND salario_medio_mensal IS NOT NULL
  AND regiao <> 'UNDECLARED'
GROUP BY regiao, cargo HAVING count(*) >= 30""",
}

_ORDER_CASE = (
    "CASE {} WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3"
    " WHEN '5-LOW' THEN 4 ELSE 5 END"
)
_RELIABLE = "gold_remuneracao WHERE survey_year = (SELECT max(survey_year) FROM silver) AND amostra_suficiente AND dimensao ="

FRAME_SQL = {
    "P1": """SELECT *, round(respondentes * 100.0 / sum(respondentes) OVER (), 2) AS pct
FROM (SELECT cargo, CAST(sum(respondentes) AS BIGINT) AS respondentes FROM gold_perfil_mercado
      WHERE survey_year = (SELECT max(survey_year) FROM silver) AND cargo IS NOT NULL GROUP BY cargo)
WHERE respondentes >= 30""",
    "P2": """SELECT survey_year,
  round(100.0 * a / (a + b + c + d), 2) AS "1-URGENT", round(100.0 * b / (a + b + c + d), 2) AS "2-HIGH",
  round(100.0 * c / (a + b + c + d), 2) AS "3-MEDIUM", round(100.0 * d / (a + b + c + d), 2) AS "5-LOW"
FROM (SELECT survey_year,
        sum(CASE WHEN senioridade = '1-URGENT' THEN respondentes ELSE 0 END) AS a,
        sum(CASE WHEN senioridade = '2-HIGH' THEN respondentes ELSE 0 END) AS b,
        sum(CASE WHEN senioridade = '3-MEDIUM' THEN respondentes ELSE 0 END) AS c,
        sum(CASE WHEN senioridade = '5-LOW' THEN respondentes ELSE 0 END) AS d
      FROM gold_perfil_mercado WHERE senioridade IS NOT NULL GROUP BY survey_year)""",
    "P3": f"""SELECT categoria, salario_mediano,
  round(salario_mediano / first_value(salario_mediano)
        OVER (ORDER BY {_ORDER_CASE.format('categoria')}), 4) AS multiplo
FROM {_RELIABLE} 'senioridade'""",
    "P4": f"""SELECT categoria, respondentes, salario_p25, salario_mediano, salario_p75
FROM {_RELIABLE} 'cargo' AND categoria <> 'FURNITURE'""",
    "P5": "SELECT survey_year, pct_mulheres FROM gold_evolucao_anual",
    "P6": """SELECT senioridade, gap_salarial_pct,
  CASE WHEN abs(gap_salarial_pct) < 0.5 THEN 'sem diferença'
       WHEN gap_salarial_pct < 0 THEN 'negativo' ELSE 'positivo' END AS classe
FROM gold_diversidade_genero WHERE survey_year = (SELECT max(survey_year) FROM silver) AND genero = 'F' AND amostra_suficiente""",
    "P7": """SELECT * EXCLUDE (rk, mx),
  CAST(survey_year AS VARCHAR) || '-' || right(CAST(survey_year + 1 AS VARCHAR), 2) AS edicao
FROM (SELECT *, row_number() OVER (PARTITION BY categoria ORDER BY pct_adocao DESC, tecnologia) AS rk
      FROM (SELECT *, max(survey_year) OVER (PARTITION BY categoria) AS mx FROM gold_tecnologias)
      WHERE survey_year = mx)
WHERE rk <= 7""",
    "P8": """SELECT e.survey_year, pct_usa_ia_generativa, pct_empresa_prioriza_ia, n_pessoal, n_empresa,
  round(pct_usa_ia_generativa - pct_empresa_prioriza_ia, 2) AS contraste_pp
FROM gold_evolucao_anual e JOIN
  (SELECT survey_year, CAST(sum(base_uso_pessoal) AS BIGINT) AS n_pessoal,
          CAST(sum(base_uso_empresa) AS BIGINT) AS n_empresa
   FROM gold_adocao_ia GROUP BY survey_year) b ON e.survey_year = b.survey_year""",
    "P9": """SELECT survey_year, 'A' AS modelo_trabalho, pct_presencial AS pct FROM gold_evolucao_anual
UNION ALL SELECT survey_year, 'N', pct_hibrido FROM gold_evolucao_anual
UNION ALL SELECT survey_year, 'R', pct_remoto FROM gold_evolucao_anual""",
    "P10": """SELECT *, round((salario_comparada - salario_referencia) * 100.0 / salario_referencia, 2)
    AS diferenca_pct,
  coalesce(n_comparada >= 30 AND n_referencia >= 30, false) AS confiavel
FROM (SELECT senioridade,
        max(CASE WHEN regiao = 'AFRICA' THEN salario_medio END) AS salario_comparada,
        max(CASE WHEN regiao = 'AFRICA' THEN respondentes END) AS n_comparada,
        max(CASE WHEN regiao = 'EUROPE' THEN salario_medio END) AS salario_referencia,
        max(CASE WHEN regiao = 'EUROPE' THEN respondentes END) AS n_referencia
      FROM gold_remuneracao_regional WHERE survey_year = (SELECT max(survey_year) FROM silver) AND regiao IN ('AFRICA', 'EUROPE')
      GROUP BY senioridade)""",
    "P11": """SELECT categoria, survey_year, salario_mediano,
  last_value(survey_year) OVER w AS ultima_edicao,
  last_value(salario_mediano) OVER w AS ultimo_salario
FROM gold_remuneracao WHERE dimensao = 'senioridade' AND amostra_suficiente
WINDOW w AS (PARTITION BY categoria ORDER BY survey_year
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "P12": """SELECT CAST(v.posicao AS INTEGER) AS posicao, v.resultado_ia_empresa, g.survey_year,
  g.respondentes, g.pct
FROM (VALUES (1, 'F-A'), (2, 'F-N'), (3, 'F-R'), (4, 'O-A'), (5, 'O-N'), (6, 'O-R'), (7, 'X-X'))
  v(posicao, resultado_ia_empresa)
LEFT JOIN (SELECT * FROM gold_impacto_ia
           WHERE survey_year = (SELECT max(survey_year) FROM gold_impacto_ia)) g
  ON v.resultado_ia_empresa = g.resultado_ia_empresa""",
}

FIRST, LAST = "(SELECT min(survey_year) FROM silver)", "(SELECT max(survey_year) FROM silver)"
_EVO = "SELECT {} FROM gold_evolucao_anual WHERE survey_year = {}"
_PAY2 = f"FROM {_RELIABLE}"


def _reg(region: str, level: str) -> str:
    return (
        "(SELECT max(salario_medio) FROM gold_remuneracao_regional WHERE survey_year = (SELECT max(survey_year) FROM silver)"
        f" AND amostra_suficiente AND regiao = '{region}' AND senioridade = '{level}')"
    )


def _discount(level: str) -> str:
    a, e = _reg("AFRICA", level), _reg("EUROPE", level)
    return f"-round(({a} - {e}) * 100.0 / {e}, 2)"


def _top(label: str, value: str = "tecnologia") -> str:
    return (
        f"(SELECT {value} FROM gold_tecnologias WHERE categoria = '{label}'"
        " ORDER BY survey_year DESC, pct_adocao DESC, tecnologia DESC LIMIT 1)"
    )


_IMPACT = "gold_impacto_ia WHERE survey_year = (SELECT max(survey_year) FROM gold_impacto_ia)"

FRAME_SQL["K1"] = f"""
SELECT *, round(pct_ia_ultimo - pct_empresa_ia_ultimo, 2) AS lacuna_ia,
  round(sal_senior / sal_junior, 4) AS multiplo_senior,
  -round((regiao_barata_sal - regiao_cara_sal) * 100.0 / regiao_cara_sal, 2)
    AS desconto_regional_bruto
FROM (SELECT
  (SELECT CAST(sum(total_respondentes) AS BIGINT) FROM gold_evolucao_anual) AS total_respondentes,
  (SELECT string_agg(survey_year || ':' || total_respondentes, ',' ORDER BY survey_year)
   FROM gold_evolucao_anual) AS respondentes_por_edicao,
  ({_EVO.format('pct_usa_ia_generativa', LAST)}) AS pct_ia_ultimo,
  ({_EVO.format('pct_usa_ia_generativa', FIRST)}) AS pct_ia_primeiro,
  ({_EVO.format('pct_empresa_prioriza_ia', LAST)}) AS pct_empresa_ia_ultimo,
  ({_EVO.format('pct_mulheres', FIRST)}) AS pct_mulheres_primeiro,
  ({_EVO.format('pct_mulheres', LAST)}) AS pct_mulheres_ultimo,
  ({_EVO.format('pct_remoto', FIRST)}) AS pct_remoto_primeiro,
  ({_EVO.format('pct_remoto', LAST)}) AS pct_remoto_ultimo,
  ({_EVO.format('pct_presencial', FIRST)}) AS pct_presencial_primeiro,
  ({_EVO.format('pct_presencial', LAST)}) AS pct_presencial_ultimo,
  (SELECT CAST(sum(base_uso_pessoal) AS BIGINT) FROM gold_adocao_ia WHERE survey_year = (SELECT max(survey_year) FROM silver))
    AS base_uso_pessoal_ia,
  (SELECT CAST(sum(base_uso_empresa) AS BIGINT) FROM gold_adocao_ia WHERE survey_year = (SELECT max(survey_year) FROM silver))
    AS base_uso_empresa_ia,
  (SELECT salario_mediano {_PAY2} 'senioridade' AND categoria = '1-URGENT') AS sal_junior,
  (SELECT salario_mediano {_PAY2} 'senioridade' AND categoria = '3-MEDIUM') AS sal_senior,
  (SELECT salario_mediano {_PAY2} 'senioridade' AND categoria = '5-LOW') AS sal_especialista,
  (SELECT categoria {_PAY2} 'cargo' AND categoria <> 'FURNITURE'
   ORDER BY salario_mediano DESC, categoria DESC LIMIT 1) AS cargo_topo,
  (SELECT max(salario_mediano) {_PAY2} 'cargo' AND categoria <> 'FURNITURE') AS cargo_topo_sal,
  (SELECT categoria {_PAY2} 'regiao' ORDER BY salario_medio DESC, categoria DESC LIMIT 1)
    AS regiao_cara,
  (SELECT max(salario_medio) {_PAY2} 'regiao') AS regiao_cara_sal,
  (SELECT categoria {_PAY2} 'regiao' ORDER BY salario_medio, categoria LIMIT 1) AS regiao_barata,
  (SELECT min(salario_medio) {_PAY2} 'regiao') AS regiao_barata_sal,
  (SELECT cargo FROM gold_perfil_mercado WHERE survey_year = (SELECT max(survey_year) FROM silver) AND cargo IS NOT NULL
   GROUP BY cargo ORDER BY sum(respondentes) DESC, cargo DESC LIMIT 1) AS cargo_maior_volume,
  (SELECT CAST(max(n) AS BIGINT) FROM (SELECT sum(respondentes) AS n FROM gold_perfil_mercado
   WHERE survey_year = (SELECT max(survey_year) FROM silver) AND cargo IS NOT NULL GROUP BY cargo)) AS cargo_maior_volume_n,
  {_discount('1-URGENT')} AS desconto_regional_junior,
  {_discount('3-MEDIUM')} AS desconto_regional_senior,
  (SELECT gap_salarial_pct FROM gold_diversidade_genero WHERE survey_year = (SELECT max(survey_year) FROM silver)
   AND genero = 'F' AND senioridade = '3-MEDIUM') AS gap_senior,
  {_top('Linguagem')} AS top_linguagens, {_top('Linguagem', 'pct_adocao')} AS top_linguagens_pct,
  {_top('Banco de dados')} AS top_bancos_dados, {_top('Banco de dados', 'pct_adocao')} AS top_bancos_dados_pct,
  {_top('Cloud')} AS top_cloud_utilizada, {_top('Cloud', 'pct_adocao')} AS top_cloud_utilizada_pct,
  {_top('Ferramenta de BI')} AS top_ferramentas_bi, {_top('Ferramenta de BI', 'pct_adocao')} AS top_ferramentas_bi_pct,
  (SELECT max(CASE WHEN resultado_ia_empresa = 'O-R' THEN pct END) FROM {_IMPACT})
    AS pct_ia_producao,
  (SELECT max(CASE WHEN resultado_ia_empresa = 'O-A' THEN pct END) FROM {_IMPACT}) AS pct_ia_piloto,
  (SELECT CAST(sum(respondentes) AS BIGINT) FROM {_IMPACT}) AS base_impacto_ia)"""


def _register() -> None:
    for key, name in MART_KEYS.items():
        REGISTRY.add(
            key,
            lambda spark, sf_dir, name=name: lake(spark, sf_dir).mart(name),
            with_marts(f"SELECT * FROM {name}"),
        )
    for name, query in QUERIES.items():
        REGISTRY.add(
            name,
            lambda spark, sf_dir, query=query: query(lake(spark, sf_dir)),
            with_marts(QUERY_SQL[name]),
        )
    for name, frame in FRAMES.items():
        REGISTRY.add(
            name,
            lambda spark, sf_dir, frame=frame: frame(lake(spark, sf_dir)),
            with_marts(FRAME_SQL[name]),
        )


_register()
