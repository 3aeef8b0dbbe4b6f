"""What is ingested already: a ledger of exports, so that a run reads only what is new or replaced."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.sources import bronze

ENTRY = "exportacao string, bytes bigint, alterado bigint, survey_year int"


@dataclass
class Run:
    """Status of every export listed or in the ledger, and the rows written per edition."""

    exports: list[tuple[str, int, str]] = field(default_factory=list)  # export, edition, status
    written: dict[int, int] = field(default_factory=dict)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def listing(spark: SparkSession, raw_path: str) -> DataFrame:
    """The exports of a zone with edition, size and time of the last change; file metadata only."""
    rows = []
    for path in bronze.list_csv_files(spark, raw_path):
        files = bronze.files_of(spark, path)
        size = sum(one.getLen() for one in files)
        rows.append((path, size, max((one.getModificationTime() for one in files), default=0), bronze.edition_year(path)))
    return spark.createDataFrame(rows, ENTRY)


def entries(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The ledger's rows; none where there is no ledger yet."""
    if not exists(spark, ledger_path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(ledger_path)


def status(listed: DataFrame, known: DataFrame) -> DataFrame:
    """(export, edition, status): ``nova``, ``substituida``, ``retirada`` or ``igual``."""
    same = (F.col("l.bytes") == F.col("k.bytes")) & (F.col("l.alterado") == F.col("k.alterado")) & (F.col("l.survey_year") == F.col("k.survey_year"))
    kind = (
        F.when(F.col("k.exportacao").isNull(), "nova").when(F.col("l.exportacao").isNull(), "retirada").when(same, "igual").otherwise("substituida")
    )
    joined = listed.alias("l").join(known.alias("k"), F.col("l.exportacao") == F.col("k.exportacao"), "full")
    year = F.coalesce("l.survey_year", "k.survey_year").alias("survey_year")
    return joined.select(F.coalesce("l.exportacao", "k.exportacao").alias("exportacao"), year, kind.alias("situacao"))


def ingest_changes(spark: SparkSession, raw_path: str, bronze_path: str, ledger_path: str, multi_line: bool = True) -> Run:
    """Ingest the editions that have a new or replaced export; all others are neither read nor written.

    An edition is written whole, from all exports it has now. A withdrawn export is reported; its rows
    leave with the next writing of its edition, and an edition of which all exports are withdrawn
    stays as it is. The ledger follows Bronze, so a run that breaks off is done again by the next one.
    """
    listed = listing(spark, raw_path)
    found = [tuple(row) for row in status(listed, entries(spark, ledger_path)).orderBy("exportacao").collect()]
    changed = sorted({year for _, year, kind in found if kind in ("nova", "substituida")})
    run = Run(found)
    if not changed:
        return run
    paths = [path for path, year, kind in found if year in changed and kind != "retirada"]
    run.written = {year: counts["rows"] for year, counts in bronze.write_editions(spark, paths, bronze_path, multi_line).items()}
    (
        listed.where(F.col("survey_year").isin(changed))
        .coalesce(1)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("survey_year")
        .parquet(ledger_path)
    )
    return run
