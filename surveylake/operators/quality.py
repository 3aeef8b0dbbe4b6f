"""Content checks: emptiness, NULL columns, contracts, editions, duplicates, equality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.operators.compare import ordered_list


def is_empty(df: DataFrame, name: str) -> DataFrame:
    """(table, empty); stops at the first row."""
    return df.limit(1).groupBy().agg(
        F.lit(name).alias("tabela"), (F.count(F.lit(1)) == 0).alias("vazia")
    )


def column_fill(df: DataFrame) -> DataFrame:
    """(column, non_null, rows, all_null), all columns counted over all rows in one pass."""
    counted = df.groupBy().agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{column}`")).alias(f"_c{i}") for i, column in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(column).alias("coluna"), F.col(f"_c{i}").alias("preenchidas"))
            for i, column in enumerate(df.columns)
        ]
    )
    return counted.select(F.col("_rows").alias("linhas"), F.inline(rows)).withColumn(
        "toda_nula", (F.col("preenchidas") == 0) & (F.col("linhas") > 0)
    )


def query_report(results: Mapping[str, DataFrame]) -> DataFrame:
    """(query, rows, problems, status) for a list of queries, each read in full."""
    parts = []
    for name, df in results.items():
        counts = df.groupBy().agg(
            F.count(F.lit(1)).alias("linhas"),
            F.array_join(
                F.array_compact(
                    F.array(
                        *[
                            F.when(F.count(F.col(f"`{column}`")) == 0, F.lit(column))
                            for column in sorted(df.columns)
                        ]
                    )
                ),
                ", ",
            ).alias("_nulls"),
        )
        problem = F.when(F.col("linhas") == 0, F.lit("0 linhas")).when(
            F.col("_nulls") != "", F.concat(F.lit("colunas nulas: "), F.col("_nulls"))
        )
        parts.append(
            counts.select(
                F.lit(name).alias("consulta"),
                "linhas",
                F.coalesce(problem, F.lit("")).alias("problemas"),
                F.when(problem.isNull(), F.lit("OK")).otherwise(F.lit("FALHA")).alias("status"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def contract_report(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """(column, expected, found, matches, non_null) against a column contract."""
    found = dict(df.dtypes)
    filled = column_fill(df).select("coluna", "preenchidas")
    spark = df.sparkSession
    columns = list(contract) + [column for column in df.columns if column not in contract]
    rows = [(column, contract.get(column), found.get(column)) for column in columns]
    compared = spark.createDataFrame(rows, "coluna string, esperado string, encontrado string")
    return compared.join(filled, "coluna", "left").withColumn(
        "confere", F.col("esperado").eqNullSafe(F.col("encontrado"))
    )


def contracts_report(tables: Mapping[str, tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """The reports of several tables with their contracts, each table read once."""
    reports = [contract_report(df, contract).select(F.lit(name).alias("tabela"), "*") for name, (df, contract) in tables.items()]
    return reduce(DataFrame.unionByName, reports)


def edition_report(
    df: DataFrame, editions: Sequence[int], edition: str = "survey_year", key: str = "respondente_id"
) -> DataFrame:
    """(edition, expected, rows, keys, repeated keys) for every edition expected or found.

    An absent edition has zeros; one that nobody expected is reported as such, and so is a NULL one.
    """
    per_key = df.groupBy(edition, key).agg(F.count(F.lit(1)).alias("_n"))
    counted = per_key.groupBy(edition).agg(
        F.sum("_n").alias("linhas"),
        F.count(F.lit(1)).alias("chaves"),
        F.sum((F.col("_n") > 1).cast("long")).alias("repetidas"),
    )
    wanted = ordered_list(df, [str(year) for year in editions], edition).select(
        F.col(edition).cast("int").alias("_year"), F.lit(True).alias("esperada")
    )
    return wanted.join(counted, F.col("_year") == F.col(edition), "full").select(
        F.coalesce(F.col(edition), "_year").alias(edition),
        F.coalesce("esperada", F.lit(False)).alias("esperada"),
        *[F.coalesce(name, F.lit(0)).alias(name) for name in ("linhas", "chaves", "repetidas")],
    )


def block_overlap(df: DataFrame, keys: Sequence[str], first: Column, second: Column) -> DataFrame:
    """Respondents who answered each of two blocks, and both."""
    def people(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, F.lit(1))).alias(name)

    return df.groupBy(*keys).agg(
        people(first, "primeiro"), people(second, "segundo"), people(first & second, "ambos")
    )


def tables_overlap(
    first: DataFrame, second: DataFrame, edition: str = "survey_year", key: str = "respondente_id"
) -> DataFrame:
    """(edition, first, second, both): respondents with a row in each of two tables, and in both.

    Over two tables bucketed alike by the respondent, ids are grouped and joined where they lie, and
    only one row per edition and task is shuffled. The join is on the respondent alone, with the
    editions of each as a list: on both keys Spark would deal the buckets anew. Rows without edition
    or id are nobody's.
    """
    def people(df: DataFrame, name: str) -> DataFrame:
        known = df.where(F.col(edition).isNotNull() & F.col(key).isNotNull())
        return known.groupBy(key).agg(F.collect_set(edition).alias(name))

    joined = people(first, "_first").join(people(second, "_second"), key, "full")
    one, two = (F.coalesce(name, F.array().cast(joined.schema[name].dataType)) for name in ("_first", "_second"))
    each = joined.select(one.alias("_first"), two.alias("_second"), F.explode(F.array_union(one, two)).alias(edition))
    inside = [F.array_contains(name, F.col(edition)) for name in ("_first", "_second")]
    return each.groupBy(edition).agg(
        F.count_if(inside[0]).alias("primeiro"),
        F.count_if(inside[1]).alias("segundo"),
        F.count_if(inside[0] & inside[1]).alias("ambos"),
    )


def answer_patterns(df: DataFrame, keys: Sequence[str], blocks: Mapping[str, Column]) -> DataFrame:
    """(keys, pattern, n): respondents by the blocks they answered; bit i stands for the i-th block.

    The counts add up over any union of rows, and a table of them answers every question on
    combinations of blocks. A NULL condition is no answer.
    """
    if not 0 < len(blocks) <= 63:
        raise ValueError("1 to 63 blocks fit a pattern")
    bits = [F.when(answered, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, answered in enumerate(blocks.values())]
    pattern = reduce(Column.bitwiseOR, bits)
    return df.groupBy(*keys, pattern.alias("padrao")).agg(F.count(F.lit(1)).alias("n"))


def block_overlaps(patterns: DataFrame, keys: Sequence[str], blocks: Sequence[str]) -> DataFrame:
    """(keys, block, other, first, second, both) for every pair of blocks, from ``answer_patterns``."""
    blocks = list(blocks)
    pairs = [
        F.struct(F.lit(one).alias("bloco"), F.lit(two).alias("outro"), F.lit(1 << i).cast("long").alias("_one"), F.lit(1 << j).cast("long").alias("_two"))
        for i, one in enumerate(blocks)
        for j, two in enumerate(blocks)
        if i < j
    ]
    each = patterns.select(*keys, "padrao", "n", F.inline(F.array(*pairs)))
    one, two = (F.col("padrao").bitwiseAND(F.col(bit)) != 0 for bit in ("_one", "_two"))

    def people(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0))).alias(name)

    return each.groupBy(*keys, "bloco", "outro").agg(people(one, "primeiro"), people(two, "segundo"), people(one & two, "ambos"))


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose multiplicity differs, with ``sobra`` = copies on the left minus the right.

    One aggregation over both sides; two equal tables give no rows. Tables whose columns differ are
    no candidates for a row-by-row comparison and raise an error.
    """
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"different columns: {sorted(set(columns) ^ set(right.columns))}")
    signed = left.withColumn("_sign", F.lit(1)).unionByName(
        right.select(*columns).withColumn("_sign", F.lit(-1))
    )
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("sobra")).where(F.col("sobra") != 0)
