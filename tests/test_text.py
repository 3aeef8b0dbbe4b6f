import pytest
from pyspark.sql import functions as F

from surveylake.functions import text as X


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row["r"] for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def on_clean(function):
    return lambda v: function(X.clean_text(v))


CASES = {
    "clean": (X.clean_text, {" a ": "a", "": None, "NaN": None, " - ": None, " x\t": "x", "null": None}),
    "accents": (X.strip_accents, {"ação": "acao", "Júnior": "Junior", "é": "e", "ñÑ": "nN", "plain": "plain", "½ ﬁm ŉ": "1⁄2 fim ʼn",
        "й ά Ａｂ１": "и α Ab1", "e\u0301": "e", "ẞ": "ẞ", "Ǆ": "DZ"}),
    "salary": (on_clean(X.salary_midpoint), {
        "de R$ 4.001/mês a R$ 6.000/mês": 5000.5,
        "Acima de R$ 40.001/mês": 50001.25,
        "Menos de R$ 1.000/mês": 500.0,
        "Até R$ 2.000": 1000.0,
        "R$ 10000": 10000.0,
        "R$ 10000,50": 10000.5,
        "não recebo": None,
        "sem renda": None,
        "50": None,
        "debate de R$ 3.000": 3000.0,
        "nada": None,
    }),
    "yes_no": (on_clean(X.yes_no), {
        "Sim": True, "sim, claro": True, "1": True, "1.0": True, "NÃO": False, "nunca": False,
        "0": False, "não sei": None, "nao sei": None, "talvez": None, "nan": None, "-": None,
    }),
    "seniority": (on_clean(X.seniority_label), {
        "JÚNIOR": "Júnior", "Senior": "Sênior", "Especialista/Staff": "Especialista/Staff+",
        " Gerente ": "Gerente", "": None,
    }),
    "job": (on_clean(X.job_label), {
        "Engenheiro de Machine Learning/ML Engineer": "ML Engineer / MLOps",
        "Engenheiro de Dados": "Engenheiro de Dados", "Outra Opção": "Outros",
    }),
    "model": (on_clean(X.work_model_label), {
        "Modelo híbrido com dias fixos de trabalho presencial": "Híbrido",
        "Modelo 100% remoto".replace(" ", " "): "Remoto", "presencial": "Presencial",
    }),
    "uses": (on_clean(X.uses_ai), {"Não utilizo nenhum tipo": False, "Copilot": True, "-": None}),
    "priority": (on_clean(X.company_prioritises_ai), {
        "Sim, é prioridade": True, "Mais ou menos": False, "Não sei opinar": None, "null": None,
    }),
    "age": (X.age_in_years, {"25": 25, "25.0": 25, " 30 ": 30, "x": None, "": None, "99999999999": None}),
    "region": (X.region_of_state, {"SP": "Sudeste", "BA": "Nordeste", "XX": None}),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    expression, expected = CASES[name]
    assert apply(spark, list(expected), expression) == list(expected.values())


def test_blocks_keep_skipped_apart_from_none(spark):
    df = spark.createDataFrame(
        [(0, None, None, None), (1, "0", "0", "1"), (2, "1", "sim", None), (3, "1", None, "0")],
        "i int, a string, b string, none string",
    )
    labels = X.chosen_labels(
        [(F.col("a"), "AWS"), (F.col("b"), "AWS")], [F.col("a"), F.col("b"), F.col("none")]
    )
    got = {row["i"]: row["r"] for row in df.select("i", labels.alias("r")).collect()}
    assert got == {0: None, 1: [], 2: ["AWS"], 3: ["AWS"]}


def test_edition_label_and_ratio(spark):
    row = spark.range(1).select(
        X.edition_label(F.lit(2023)).alias("e"), X.percentage(F.lit(1), F.lit(0)).alias("z")
    ).first()
    assert row["e"] == "2023-24" and row["z"] is None
