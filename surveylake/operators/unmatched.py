"""Answers that no rule knows: their share, their number of spellings and the most frequent ones."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.functions import text as X
from surveylake.functions.text import percentage

# The number of spellings is off by more than this with a probability below one in a thousand.
SPELLINGS_ERROR = 0.08
# Spellings followed at once; with no more spellings than that, the counts of the top ones are exact.
FOLLOWED = 10_000


@dataclass(frozen=True)
class Answered:
    """A cleaned answer (NULL: none), and whether a rule knows it."""

    answer: Column
    known: Column


def by_rules(column: str, rule_list: list[tuple[str, str]]) -> Answered:
    cleaned = X.clean_text(F.col(column))
    return Answered(cleaned, X.known_by_rules(X.fold(cleaned), rule_list))


def by_value(column: str, parsed: Column) -> Answered:
    """An answer whose parser gives NULL is unknown."""
    return Answered(X.clean_text(F.col(column)), parsed.isNotNull())


def unmatched_answers(df: DataFrame, fields: Mapping[str, Answered], top: int = 10, followed: int = FOLLOWED) -> DataFrame:
    """Per field: answers, those no rule knows, their share, spellings (about) and the ``top`` spellings with counts.

    One pass over the table with sketches of bounded size; a blank answer is none.
    """
    unknown = [
        F.when(field.answer.isNotNull() & ~F.coalesce(field.known, F.lit(False)), field.answer).alias(f"_u{i}")
        for i, field in enumerate(fields.values())
    ]
    answers = [field.answer.isNotNull().alias(f"_a{i}") for i, field in enumerate(fields.values())]
    marked = df.select(*answers, *unknown)
    counts = []
    for i in range(len(fields)):
        counts += [
            F.count_if(f"_a{i}").alias(f"_n{i}"),
            F.count(f"_u{i}").alias(f"_m{i}"),
            F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(f"_u{i}")), F.lit(0)).cast("long").alias(f"_d{i}"),
            F.expr(f"approx_top_k(_u{i}, {int(top)}, {int(followed)}) FILTER (WHERE _u{i} IS NOT NULL)").alias(f"_t{i}"),
        ]
    one = marked.groupBy().agg(*counts)
    rows = [
        F.struct(
            F.lit(name).alias("campo"),
            F.col(f"_n{i}").alias("respondidas"),
            F.col(f"_m{i}").alias("sem_regra"),
            percentage(F.col(f"_m{i}"), F.col(f"_n{i}")).alias("pct_sem_regra"),
            F.col(f"_d{i}").alias("grafias"),
            F.transform(F.col(f"_t{i}"), lambda t: F.struct(t["item"].alias("grafia"), t["count"].alias("n"))).alias("principais"),
        )
        for i, name in enumerate(fields)
    ]
    return one.select(F.inline(F.array(*rows)))
