"""Fixed values of the survey domain: rule lists, lookups, vocabularies and table contracts.

Everything here is data. The label rules are matched against lower-case text without accents
(see ``text.fold``), first match wins, so an accented and an unaccented spelling, in any case,
reach the same label.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: missing answers -------------------------------------------------------
BLANK_SPELLINGS = ("", "nan", "none", "null", "-")

# --- Fixed values: label rules, in priority order ----------------------------------------
SENIORITY_RULES = [
    (r"junior|trainee|estagi", "Júnior"),
    (r"pleno", "Pleno"),
    (r"especialista|staff", "Especialista/Staff+"),
    (r"senior", "Sênior"),
]

# Hybrid comes before on-site: "híbrido com dias fixos presencial" names both.
WORK_MODEL_RULES = [
    (r"hibrido", "Híbrido"),
    (r"100%\s*remoto|totalmente\s+remoto|^remoto", "Remoto"),
    (r"presencial", "Presencial"),
]

# Machine-learning engineers come before data engineers.
JOB_RULES = [
    (r"engenheiro.*machine\s*learning|ml\s*engineer|mlops", "ML Engineer / MLOps"),
    (r"cientista\s*de\s*dados|data\s*scientist", "Cientista de Dados"),
    (
        r"engenheiro\s*de\s*dados|data\s*engineer|arquiteto\s*de\s*dados|data\s*architect",
        "Engenheiro de Dados",
    ),
    (r"analista\s*de\s*bi|bi\s*analyst|business\s*intelligence", "Analista de BI"),
    (r"analytics\s*engineer", "Analytics Engineer"),
    (r"analista\s*de\s*dados|data\s*analyst", "Analista de Dados"),
    (r"product\s*manager|gerente\s*de\s*produto|product\s*owner", "Produto"),
    (r"analista\s*de\s*negocios|business\s*analyst", "Analista de Negócios"),
    (
        r"desenvolvedor|software\s*engineer|engenheiro\s*de\s*software",
        "Engenharia de Software",
    ),
    (r"estatistic|economista", "Estatística / Economia"),
    (r"professor|pesquisador", "Academia / Pesquisa"),
    (r"dba|administrador\s*de\s*banco", "DBA"),
    (r"outra\s*opcao|outro", "Outros"),
]

GENDER_RULES = [
    (r"^masculino|^homem", "Masculino"),
    (r"^feminino|^mulher", "Feminino"),
    (r"outro|prefiro\s*nao|nao\s*binari", "Outro / Não informado"),
]

# Answers may be comma-joined; the highest commitment is tested first.
AI_USAGE_RULES = [
    (r"nao\s+utilizo\s+nenhum", "Não utiliza"),
    (r"empresa\s+em\s+que\s+trabalho\s+paga", "Paga — custeada pela empresa"),
    (r"pago\s+do\s+meu\s+proprio\s+bolso", "Paga — custeada pelo profissional"),
    (r"copilot|ai\s+para\s+codigo|github\s+copilot|cursor", "Ferramentas de código (Copilot)"),
    (r"solucoes\s+gratuitas|apenas.*gratuit", "Apenas soluções gratuitas"),
]

AI_PRIORITY_RULES = [
    (r"^sim,?\s*e\s*nossa\s*principal\s*prioridade", "Prioridade máxima"),
    (r"^sim", "Alta prioridade"),
    (r"^mais\s*ou\s*menos", "Iniciativa isolada"),
    (r"nao\s*e\s*uma\s*iniciativa", "Não é prioridade"),
    (r"nao\s*sei\s*opinar", "Não sabe opinar"),
]

AI_RESULT_RULES = [
    (r"nao\s*sei\s*opinar", "Não sabe opinar"),
    (r"^sim.*producao", "Em produção, com resultado"),
    (r"em\s+partes|piloto", "Piloto, sem resultado ainda"),
    (r"ainda\s+nao\s+comecamos", "Não começou"),
    (r"investigacao", "Em investigação/planejamento"),
]

# --- Fixed values: yes / no spellings (accents folded) -----------------------------------
TRUE_SPELLINGS = ("1", "1.0", "true", "sim", "yes", "s", "verdadeiro")
FALSE_SPELLINGS = ("0", "0.0", "false", "nao", "no", "n", "falso")

# --- Fixed values: salary bands ----------------------------------------------------------
SMALLEST_SALARY = 100.0
UNPAID_WORDS = r"nao recebo|sem renda"
BELOW_WORDS = r"menos de|\bate\b"
ABOVE_WORDS = r"acima|mais de|maior"
BELOW_FACTOR = 0.5
ABOVE_FACTOR = 1.25

# --- Fixed values: states of each macro-region -------------------------------------------
REGION_STATES = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}

# --- Fixed values: sectors counted as finance --------------------------------------------
FINANCE_WORDS = ("financ", "banco", "seguro")


@dataclass(frozen=True)
class FieldSpec:
    """Where a canonical field lives: header patterns by priority, and what disqualifies."""

    name: str
    patterns: tuple[str, ...]
    exclude: tuple[str, ...] = ()


# A header such as p4_d_1_sql is one option of a multi-select block, not a question.
OPTION_OF_BLOCK = r"_\d+_"

# --- Fixed values: the canonical respondent fields, in resolution order -------------------
CANONICAL_FIELDS = [
    FieldSpec("respondente_id", (r"^p0_id$", r"^p0_a_token$")),
    FieldSpec("idade", (r"^p1_a_idade$",)),
    FieldSpec("faixa_idade", (r"^p1_a_1_faixa_idade$",)),
    FieldSpec("genero", (r"^p1_b_genero$",)),
    FieldSpec("cor_raca_etnia", (r"^p1_c_cor_raca_etnia$",)),
    FieldSpec("pcd", (r"^p1_d_pcd$",)),
    FieldSpec("uf_residencia", (r"uf_onde_mora",)),
    FieldSpec("regiao_declarada", (r"regiao_onde_mora",)),
    FieldSpec("nivel_ensino", (r"nivel_de_ensino",)),
    FieldSpec("area_formacao", (r"area_de_formacao",)),
    FieldSpec("situacao_trabalho", (r"situacao_(atual_)?de_trabalho", r"^p2_a_"), (OPTION_OF_BLOCK,)),
    FieldSpec("setor_empresa", (r"^p2_b_setor$",)),
    FieldSpec("porte_empresa", (r"numero_de_funcionarios",)),
    FieldSpec("gestor", (r"^p2_d_(atua_como_)?gestor$",), (OPTION_OF_BLOCK,)),
    FieldSpec("cargo", (r"^p2_f_cargo_atual$",)),
    FieldSpec("senioridade", (r"^p2_[a-z]_nivel$",), (OPTION_OF_BLOCK,)),
    FieldSpec("faixa_salarial", (r"^p2_[a-z]_faixa_salarial$",), (OPTION_OF_BLOCK,)),
    FieldSpec(
        "tempo_experiencia_dados",
        (r"tempo_de_experiencia_(em|na_area_de)_dados", r"experiencia_na_area_de_dados"),
        (OPTION_OF_BLOCK,),
    ),
    FieldSpec(
        "tempo_experiencia_ti",
        (r"tempo_de_experiencia_em_ti", r"experiencia_na_area_de_ti"),
        (OPTION_OF_BLOCK,),
    ),
    # Every edition also asks for the ideal work model, which must not be taken for the current one.
    FieldSpec(
        "modelo_trabalho",
        (
            r"modelo_de_trabalho_atual",
            r"atualmente_qual_a_sua_forma_de_trabalho",
            r"forma_de_trabalho",
        ),
        (r"ideal", r"retorno_presencial", r"atitude", OPTION_OF_BLOCK),
    ),
    FieldSpec("satisfacao_empresa", (r"^p2_k_(voce_esta_)?satisfeito",), (OPTION_OF_BLOCK,)),
    FieldSpec(
        "motivo_insatisfacao",
        (r"motivo_insatisfacao", r"principal_motivo_da_sua_insatisfacao"),
        (OPTION_OF_BLOCK,),
    ),
    FieldSpec("busca_nova_oportunidade", (r"planos_de_mudar_de_emprego",), (OPTION_OF_BLOCK,)),
    FieldSpec("empresa_teve_layoff", (r"passou_por_layoff",), (OPTION_OF_BLOCK,)),
    FieldSpec("tipo_uso_ia", (r"(usa|utiliza)_chatgpt",), (OPTION_OF_BLOCK,)),
    FieldSpec("prioridade_ia_empresa", (r"ai_generativa.*prioridade",), (OPTION_OF_BLOCK,)),
    FieldSpec("resultado_ia_empresa", (r"bons_resultados_com_llms",), (OPTION_OF_BLOCK,)),
    FieldSpec(
        "cloud_preferida",
        (r"^p4_[a-z]_cloud_preferida$", r"cloud_preferida"),
        (OPTION_OF_BLOCK, r"dentre_as_opcoes"),
    ),
    FieldSpec(
        "possui_data_lake",
        (r"possui_data_lake", r"organizacao_possui_um_data_lake"),
        (OPTION_OF_BLOCK,),
    ),
]

# --- Fixed values: the multi-select blocks, found through their parent question ------------
MULTI_SELECT_BLOCKS = [
    FieldSpec(
        "linguagens",
        (
            r"linguagem_de_programacao_dia_a_dia",
            r"quais_das_linguagens_listadas.*utiliza_no_trabalho",
        ),
        (r"mais_utiliza", r"preferida", r"qual_e_a_que", OPTION_OF_BLOCK),
    ),
    FieldSpec(
        "bancos_dados",
        (r"banco_de_dados_dia_a_dia", r"quais_dos_bancos_de_dados.*utiliza_no_trabalho"),
        (r"preferid", OPTION_OF_BLOCK),
    ),
    FieldSpec(
        "cloud_utilizada",
        (r"^p4_[a-z]_cloud_dia_a_dia$", r"cloud_dia_a_dia"),
        (r"preferida", OPTION_OF_BLOCK),
    ),
    FieldSpec(
        "ferramentas_bi",
        (r"ferramenta_de_bi_dia_a_dia", r"ferramenta_de_bi_utilizada_no_dia_a_dia"),
        (r"preferida", OPTION_OF_BLOCK),
    ),
]

# Options of a block that name no technology.
NON_ANSWER_OPTION = r"nao_utilizo|nenhuma_das|nenhum_dos|^outra|^outro|nao_sei_informar"

# --- Fixed values: junk columns left by export tools --------------------------------------
JUNK_COLUMN = r"^unnamed|^_c\d+$"

# --- Fixed values: commercial spelling of technology names --------------------------------
DISPLAY_NAMES = {
    "amazon athena": "Amazon Athena",
    "amazon aurora ou rds": "Amazon Aurora/RDS",
    "amazon quicksight": "Amazon QuickSight",
    "amazon redshift": "Amazon Redshift",
    "amazon web services aws": "AWS",
    "aws": "AWS",
    "azure": "Azure",
    "azure microsoft": "Azure",
    "bigquery": "BigQuery",
    "c c mais mais c": "C/C++/C#",
    "cassandra": "Cassandra",
    "cloud propria": "Cloud própria",
    "coachdb": "CouchDB",
    "couchdb": "CouchDB",
    "databricks": "Databricks",
    "db2": "Db2",
    "dotnet": ".NET",
    "dynamodb": "DynamoDB",
    "elasticsearch": "Elasticsearch",
    "excel": "Excel",
    "fazemos todas as analises utilizando apenas excel ou planilhas do google": "Apenas Excel/Planilhas",
    "firebase": "Firebase",
    "gcp": "Google Cloud",
    "google bigquery": "BigQuery",
    "google cloud gcp": "Google Cloud",
    "google data studio": "Google Data Studio",
    "google firestore": "Google Firestore",
    "grafana": "Grafana",
    "hbase": "HBase",
    "ibm": "IBM",
    "ibm analytics cognos": "IBM Cognos",
    "javascript": "JavaScript",
    "js": "JavaScript",
    "looker": "Looker",
    "looker studio": "Looker Studio",
    "looker studio google data studio": "Looker Studio",
    "mariadb": "MariaDB",
    "metabase": "Metabase",
    "microsoft access": "Microsoft Access",
    "microsoft powerbi": "Power BI",
    "microstrategy": "MicroStrategy",
    "mongodb": "MongoDB",
    "mysql": "MySQL",
    "net": ".NET",
    "nosql": "NoSQL",
    "oracle": "Oracle",
    "oracle business intelligence": "Oracle BI",
    "oracle cloud": "Oracle Cloud",
    "pentaho": "Pentaho",
    "php": "PHP",
    "postgres": "PostgreSQL",
    "postgresql": "PostgreSQL",
    "power bi": "Power BI",
    "powerbi": "Power BI",
    "qlik sense": "Qlik Sense",
    "qlik view": "QlikView",
    "qlik view qlik sense": "Qlik",
    "r": "R",
    "redash": "Redash",
    "salesforce einstein analytics": "Salesforce Einstein",
    "sap business objects sap analytics": "SAP BusinessObjects",
    "sap hana": "SAP HANA",
    "sas stata": "SAS/Stata",
    "sas visual analytics": "SAS Visual Analytics",
    "servidores on premise nao utilizamos cloud": "On-premise",
    "snowflake": "Snowflake",
    "sql": "SQL",
    "sql server": "SQL Server",
    "sqlite": "SQLite",
    "superset": "Superset",
    "tableau": "Tableau",
    "teradata": "Teradata",
    "tibco spotfire": "TIBCO Spotfire",
    "typescript": "TypeScript",
    "visual basic vba": "Visual Basic/VBA",
}

# --- Fixed values: column contract of the respondent table (partitioned by survey_year) ----
SILVER_COLUMNS = {
    "respondente_id": "string",
    "idade": "int",
    "faixa_idade": "string",
    "genero": "string",
    "cor_raca_etnia": "string",
    "pcd": "boolean",
    "uf_residencia": "string",
    "nivel_ensino": "string",
    "area_formacao": "string",
    "situacao_trabalho": "string",
    "setor_empresa": "string",
    "porte_empresa": "string",
    "gestor": "boolean",
    "cargo": "string",
    "cargo_original": "string",
    "senioridade": "string",
    "faixa_salarial": "string",
    "salario_medio_mensal": "double",
    "tempo_experiencia_dados": "string",
    "tempo_experiencia_ti": "string",
    "modelo_trabalho": "string",
    "satisfacao_empresa": "string",
    "motivo_insatisfacao": "string",
    "busca_nova_oportunidade": "boolean",
    "empresa_teve_layoff": "boolean",
    "tipo_uso_ia": "string",
    "usa_ia_generativa": "boolean",
    "prioridade_ia_empresa": "string",
    "empresa_prioriza_ia": "boolean",
    "resultado_ia_empresa": "string",
    "cloud_preferida": "string",
    "possui_data_lake": "boolean",
    "linguagens": "array<string>",
    "bancos_dados": "array<string>",
    "cloud_utilizada": "array<string>",
    "ferramentas_bi": "array<string>",
    "regiao": "string",
}

# --- Fixed values: column contracts of the nine marts --------------------------------------
GOLD_COLUMNS = {
    "gold_evolucao_anual": {
        "survey_year": "int",
        "total_respondentes": "bigint",
        "idade_media": "double",
        "salario_mediano_geral": "double",
        "pct_mulheres": "double",
        "pct_remoto": "double",
        "pct_hibrido": "double",
        "pct_presencial": "double",
        "pct_usa_ia_generativa": "double",
        "pct_empresa_prioriza_ia": "double",
    },
    "gold_perfil_mercado": {
        "survey_year": "int",
        "cargo": "string",
        "senioridade": "string",
        "respondentes": "bigint",
        "idade_media": "double",
        "salario_mediano": "double",
        "pct_do_ano": "double",
        "amostra_suficiente": "boolean",
    },
    "gold_remuneracao": {
        "survey_year": "int",
        "dimensao": "string",
        "categoria": "string",
        "respondentes": "bigint",
        "salario_medio": "double",
        "salario_mediano": "double",
        "salario_p25": "double",
        "salario_p75": "double",
        "amostra_suficiente": "boolean",
    },
    "gold_diversidade_genero": {
        "survey_year": "int",
        "senioridade": "string",
        "genero": "string",
        "respondentes": "bigint",
        "salario_mediano": "double",
        "pct_representatividade": "double",
        "salario_mediano_masculino": "double",
        "gap_salarial_pct": "double",
        "amostra_suficiente": "boolean",
    },
    "gold_tecnologias": {
        "survey_year": "int",
        "categoria": "string",
        "tecnologia": "string",
        "usuarios": "bigint",
        "base_respondentes": "bigint",
        "pct_adocao": "double",
    },
    "gold_adocao_ia": {
        "survey_year": "int",
        "cargo": "string",
        "senioridade": "string",
        "respondentes": "bigint",
        "base_uso_pessoal": "bigint",
        "usam_ia": "bigint",
        "base_uso_empresa": "bigint",
        "empresas_usam_ia": "bigint",
        "pct_uso_pessoal": "double",
        "pct_uso_empresa": "double",
        "amostra_suficiente": "boolean",
    },
    "gold_impacto_ia": {
        "survey_year": "int",
        "resultado_ia_empresa": "string",
        "respondentes": "bigint",
        "pct": "double",
    },
    "gold_remuneracao_regional": {
        "survey_year": "int",
        "regiao": "string",
        "senioridade": "string",
        "respondentes": "bigint",
        "salario_medio": "double",
        "salario_mediano": "double",
        "amostra_suficiente": "boolean",
    },
    "gold_modelo_trabalho": {
        "survey_year": "int",
        "regiao": "string",
        "modelo_trabalho": "string",
        "respondentes": "bigint",
        "salario_mediano": "double",
        "pct_na_regiao": "double",
        "amostra_suficiente": "boolean",
    },
}


@dataclass(frozen=True)
class Vocabulary:
    """The labels a mart or query refers to by name; the defaults are the survey's own."""

    min_sample: int = 30
    reference_gender: str = "Masculino"
    focus_gender: str = "Feminino"
    seniority_order: tuple[str, ...] = ("Júnior", "Pleno", "Sênior", "Especialista/Staff+")
    query_levels: tuple[str, ...] = ("Júnior", "Pleno", "Sênior", "Liderança")
    junior: str = "Júnior"
    senior: str = "Sênior"
    specialist: str = "Especialista/Staff+"
    onsite: str = "Presencial"
    hybrid: str = "Híbrido"
    remote: str = "Remoto"
    reference_region: str = "Sudeste"
    compared_region: str = "Nordeste"
    undeclared: str = "Não informado"
    other_job: str = "Outros"
    sector_words: tuple[str, ...] = FINANCE_WORDS
    sector_name: str = "Setor Financeiro"
    other_sectors: str = "Demais setores"
    result_stages: tuple[str, ...] = (
        "Não começou",
        "Em investigação/planejamento",
        "Piloto, sem resultado ainda",
        "Em produção, com resultado",
        "Não sabe opinar",
    )
    stage_in_production: str = "Em produção, com resultado"
    stage_pilot: str = "Piloto, sem resultado ainda"
    salary_cuts: tuple[str, ...] = (
        "cargo",
        "senioridade",
        "regiao",
        "modelo_trabalho",
        "setor_empresa",
        "nivel_ensino",
        "tempo_experiencia_dados",
    )
    technology_blocks: dict[str, str] = field(
        default_factory=lambda: {
            "Linguagem": "linguagens",
            "Banco de dados": "bancos_dados",
            "Cloud": "cloud_utilizada",
            "Ferramenta de BI": "ferramentas_bi",
        }
    )
