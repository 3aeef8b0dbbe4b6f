"""The tables a query works on: the respondent table, the marts and the vocabulary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.functions.rules import Vocabulary
from surveylake.plans.marts import build_mart, regional_means


@dataclass(frozen=True)
class Lake:
    """``silver`` plus a way to get each mart; both stay lazy DataFrames.

    ``pay`` gives the salary mart for the cuts asked for alone, so that a query on one dimension
    neither computes nor reads the others; ``regional_means`` the regional one without its median.
    """

    silver: DataFrame
    mart: Callable[[str], DataFrame]
    words: Vocabulary
    pay: Callable[..., DataFrame]
    regional_means: Callable[[], DataFrame]

    @cached_property
    def editions(self) -> tuple[int, ...]:
        """Every edition in the data, in order; read once from the smallest mart."""
        years = self.mart("gold_evolucao_anual").select("survey_year").where(F.col("survey_year").isNotNull())
        found = tuple(sorted(row["survey_year"] for row in years.distinct().collect()))
        if not found:
            raise ValueError("the lake has no edition")
        return found

    @property
    def first_edition(self) -> int:
        return self.editions[0]

    @property
    def last_edition(self) -> int:
        return self.editions[-1]

    @property
    def newest(self) -> Column:
        """The latest edition as part of the plan that uses it; building the plan starts no job."""
        return self.mart("gold_evolucao_anual").agg(F.max("survey_year")).scalar()

    @classmethod
    def over_silver(cls, silver: DataFrame, words: Vocabulary = Vocabulary()) -> Lake:
        """Marts are computed from the respondent table inside each query."""

        def pay(*cuts: str) -> DataFrame:
            return build_mart("gold_remuneracao", silver, replace(words, salary_cuts=cuts))

        return cls(
            silver, lambda name: build_mart(name, silver, words), words, pay, lambda: regional_means(silver, words)
        )

    @classmethod
    def from_paths(
        cls,
        spark: SparkSession,
        silver_path: str,
        gold_path: str,
        words: Vocabulary = Vocabulary(),
    ) -> Lake:
        """Marts are read from the tables written by ``sources.gold.write_marts``."""
        silver = spark.read.parquet(silver_path)

        def mart(name: str) -> DataFrame:
            return spark.read.parquet(f"{gold_path}/{name}")

        def pay(*cuts: str) -> DataFrame:
            return mart("gold_remuneracao").where(F.col("dimensao").isin(*cuts))

        return cls(silver, mart, words, pay, lambda: mart("gold_remuneracao_regional").drop("salario_mediano"))
