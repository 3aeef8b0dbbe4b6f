"""Marts as Parquet tables, and all tables in a catalog database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surveylake.functions.rules import GOLD_COLUMNS, SILVER_COLUMNS, Vocabulary
from surveylake.operators.digest import partition_digests
from surveylake.plans.marts import MART_ORDER, MARTS, build_mart
from surveylake.sources.ledger import exists

DATABASE = "survey_lake"


ROWS_PER_FILE = 1_000_000


def write_mart(mart: DataFrame, name: str, gold_path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Sorted files of at most ``rows_per_file`` rows; returns the rows written.

    A mart has as many rows as there are spellings of free answers. It is split by ranges of its
    order, so a small one is one file and a large one is not written by one task.
    """
    seen = Observation()
    order = [
        F.desc(column[1:]) if column.startswith("-") else F.asc(column)
        for column in MART_ORDER[name]
    ]
    (
        mart.orderBy(*order)
        .observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{gold_path}/{name}")
    )
    return seen.get["rows"]


def write_marts(
    spark: SparkSession, silver_path: str, gold_path: str, words: Vocabulary = Vocabulary()
) -> dict[str, int]:
    """All nine marts. Each reads only its columns of the respondent table, so nothing is cached."""
    silver = spark.read.parquet(silver_path)
    return {
        name: write_mart(build_mart(name, silver, words), name, gold_path) for name in MARTS
    }


def refresh_marts(
    spark: SparkSession, silver_path: str, gold_path: str, words: Vocabulary = Vocabulary()
) -> dict[str, list[int]]:
    """Marts partitioned by edition, of which only editions that changed in Silver are built again.

    Every mart is a statement on one edition at a time, so the partition of an edition depends on its
    rows in Silver alone. Their digests are stored after the marts: a run that breaks off is done again.
    Editions no longer in Silver leave the marts. Returns the editions ``written`` and ``removed``.
    """
    silver = spark.read.parquet(silver_path)
    digests_path = f"{gold_path}/partition_digests"
    now = {row[0]: tuple(row)[1:] for row in partition_digests(silver, "survey_year").collect()}
    stored = {}
    if exists(spark, digests_path):
        stored = {row[0]: tuple(row)[1:] for row in spark.read.parquet(digests_path).collect()}
    written = sorted(year for year, digest in now.items() if stored.get(year) != digest)
    removed = sorted(set(stored) - set(now))
    if written:
        changed = silver.where(F.col("survey_year").isin(written))
        for name in MARTS:
            (
                build_mart(name, changed, words)
                .hint("rebalance", "survey_year")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("survey_year")
                .parquet(f"{gold_path}/{name}")
            )
    for year in removed:
        for name in MARTS:
            gone = spark._jvm.org.apache.hadoop.fs.Path(f"{gold_path}/{name}/survey_year={year}")
            gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    if written or removed:
        rows = [(year, *digest) for year, digest in sorted(now.items())]
        spark.createDataFrame(rows, "survey_year int, linhas bigint, digest string").coalesce(1).write.mode("overwrite").parquet(digests_path)
    return {"written": written, "removed": removed}


def _columns_sql(contract: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in contract.items())


def create_database(spark: SparkSession, database: str = DATABASE, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")


def declare_silver(spark: SparkSession, silver_path: str, database: str = DATABASE) -> None:
    """External respondent table with its contract; partitions are found under its path."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.silver"
        f" ({_columns_sql(SILVER_COLUMNS)}, survey_year int)"
        f" USING parquet PARTITIONED BY (survey_year) LOCATION '{silver_path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE `{database}`.silver")


def declare_marts(spark: SparkSession, gold_path: str, database: str = DATABASE) -> None:
    """External mart tables with their contracts."""
    for name, contract in GOLD_COLUMNS.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.{name} ({_columns_sql(contract)})"
            f" USING parquet LOCATION '{gold_path}/{name}'"
        )


def register_views(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    """Parquet folders as temporary views of the session; nothing is copied."""
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return list(paths)
