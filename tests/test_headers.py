import random
from collections import Counter

from pyspark.sql import functions as F

from surveylake.functions import headers as H
from surveylake.functions.rules import FieldSpec
from surveylake.operators.harmonise import (
    header_table,
    name_headers,
    resolution_report,
    resolve_blocks,
    resolve_fields,
    unique_names,
)

NAMES = {
    "('P1_a ', 'Idade')": "p1_a_idade",
    "('P2_h ', \"Caixa d'água + luz\")": "p2_h_caixa_d_agua_mais_luz",
    "('P4_d_1 ', 'SQL')": "p4_d_1_sql",
    "('P0', 'id')": "p0_id",
    "('P1_c ', 'Cor/raca/etnia', 'x')": "p1_c_cor_raca_etnia",
    "('P9 ', 'linha\\nnova')": "p9_linha_nova",
    "(broken', 'b'c)": "broken_b_c",
    "2.h_faixa_salarial": "p2_h_faixa_salarial",
    "4.d.1_sql": "p4_d_1_sql_2",
    "Idade": "idade",
    "2 graus": "p2_graus",
    "2024": "c_2024",
    "": "coluna_sem_nome",
    "Unnamed: 0": "unnamed_0",
    "_c12": "c12",
    "('P1_a ', 'p1_a idade')": "p1_a_idade_2",
}


def test_names(spark):
    named = name_headers(header_table(spark, {"e": list(NAMES)}))
    rows = named.orderBy("pos").collect()
    assert [row["name"] for row in rows] == list(NAMES.values())
    assert [row["raw"] for row in rows if row["junk"]] == ["Unnamed: 0"]


def test_codes_and_labels(spark):
    row = spark.range(1).select(
        H.question_code(F.lit("P1_a ")).alias("a"),
        H.question_code(F.lit("4.d.1")).alias("b"),
        H.option_label(F.lit("p4_h_1_amazon_web_services_aws")).alias("c"),
        H.option_label(F.lit("p4_g_2_power_bi")).alias("d"),
        H.option_label(F.lit("p4_d_9_kotlin")).alias("e"),
        H.is_non_answer(F.lit("p4_d_9_outra")).alias("f"),
        H.is_non_answer(F.lit("p4_d_1_sql")).alias("g"),
    ).first()
    assert tuple(row) == ("p1_a", "p4_d_1", "AWS", "Power BI", "Kotlin", True, False)


def brute_unique(names):
    taken, seen, out = set(names), Counter(), []
    last = {}
    for name in names:
        seen[name] += 1
        if seen[name] == 1:
            out.append(name)
            continue
        suffix = last.get(name, 1) + 1
        while f"{name}_{suffix}" in taken:
            suffix += 1
        last[name] = suffix
        out.append(f"{name}_{suffix}")
    return out


def test_unique_names_against_brute_force(spark):
    rng = random.Random(7)
    pool = ["x", "x_2", "x_3", "x_2_2", "y", "y_5", "z_1"]
    editions = {str(e): [rng.choice(pool) for _ in range(rng.randint(1, 40))] for e in range(12)}
    rows = [(e, i, n) for e, names in editions.items() for i, n in enumerate(names)]
    df = unique_names(spark.createDataFrame(rows, "edition string, pos int, name string"))
    got = {e: [None] * len(names) for e, names in editions.items()}
    for row in df.collect():
        got[row["edition"]][row["pos"]] = row["name"]
    assert got == {e: brute_unique(names) for e, names in editions.items()}
    assert all(len(set(names)) == len(names) for names in got.values())


def named(spark, names):
    return header_table(spark, {"e": names}).withColumnRenamed("raw", "name").withColumn(
        "junk", F.lit(False)
    )


def test_a_column_serves_one_field(spark):
    specs = [
        FieldSpec("a", (r"^x", r"y")), FieldSpec("b", (r"^x",)), FieldSpec("c", (r"^x",), (r"bad",)),
        FieldSpec("d", (r"none",)),
    ]
    headers = named(spark, ["x_long", "x", "y", "x_bad", "xz"])
    got = {row["field"]: row["name"] for row in resolve_fields(headers, specs).collect()}
    assert got == {"a": "x", "b": "xz", "c": "x_long"}
    report = resolution_report(headers, resolve_fields(headers, specs), specs)
    assert {row["field"] for row in report.where("status = 'ausente'").collect()} == {"d"}


def test_current_model_is_not_the_ideal_one(spark):
    headers = named(spark, ["p2_s_modelo_de_trabalho_ideal", "p2_q_modelo_de_trabalho_atual",
                            "p2_o_10_forma_de_trabalho"])
    got = {row["field"]: row["name"] for row in resolve_fields(headers).collect()}
    assert got == {"modelo_trabalho": "p2_q_modelo_de_trabalho_atual"}


def test_blocks_follow_their_parent(spark):
    headers = named(spark, ["p4_d_banco_de_dados_dia_a_dia", "p4_d_1_mysql", "p4_d_2_outra",
                            "p4_d_x", "p4_g_1_tableau", "p4_dd_1_no"])
    rows = resolve_blocks(headers).orderBy("name").collect()
    assert [(r["block"], r["name"], r["label"], r["technology"]) for r in rows] == [
        ("bancos_dados", "p4_d_1_mysql", "MySQL", True),
        ("bancos_dados", "p4_d_2_outra", "Outra", False),
    ]
