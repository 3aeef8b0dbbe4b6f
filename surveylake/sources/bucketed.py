"""The respondent table bucketed by respondent inside each edition, with statistics in the catalog.

Rows of one respondent lie in one bucket of every edition, so statements per (edition, respondent),
repeated ids and joins on the respondent with another table of as many buckets start from the scan
without a shuffle, and a filter on the edition still reads that partition alone.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.session import settings

EDITION, RESPONDENT = "survey_year", "respondente_id"

# Types that the catalog keeps column statistics for.
MEASURED = (T.NumericType, T.BooleanType, T.StringType, T.DateType, T.TimestampType, T.BinaryType)


def declare(spark: SparkSession, table: str, columns: Mapping[str, str], path: str, buckets: int) -> None:
    """External table over ``path``, by edition and in ``buckets`` buckets of the respondent.

    ``table`` is a qualified name; ``columns`` gives all but the edition. The number of buckets
    belongs to the files: a catalog that declares written files must name the number they were
    written with, which is checked, because a wrong one would give wrong rows. A bucket of an
    edition is one file and one task, so some hundred megabytes for each is a good size.
    """
    if buckets < 1:
        raise ValueError("a table needs at least one bucket")
    listed = ", ".join(f"`{name}` {kind}" for name, kind in columns.items() if name != EDITION)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({listed}, {EDITION} int) USING parquet"
        f" PARTITIONED BY ({EDITION}) CLUSTERED BY ({RESPONDENT}) INTO {buckets} BUCKETS"
        f" LOCATION '{path}'"
    )
    declared = int(_described(spark, table)["Num Buckets"])
    if declared != buckets:
        raise ValueError(f"{table} is declared with {declared} buckets, not {buckets}")
    _mark(spark, path, buckets)
    spark.sql(f"MSCK REPAIR TABLE {table}")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}


def _mark(spark: SparkSession, path: str, buckets: int) -> None:
    """An empty file beside the editions that names their number of buckets; another number is an error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets_*")) or []
    written = {int(mark.getPath().getName().removeprefix("_buckets_")) for mark in marks}
    if written - {buckets}:
        raise ValueError(f"{path} was written in {sorted(written)} buckets, not {buckets}")
    if not written:
        if files.exists(folder) and len(files.listStatus(folder)):
            raise ValueError(f"{path} holds files that were not written in buckets")
        files.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets_{buckets}")).close()


def write(silver: DataFrame, table: str) -> None:
    """Replace the editions that ``silver`` has in a declared table.

    Editions it does not have stay as they are. Statistics are those of the last ``analyse``.
    ``insertInto`` takes the mode of overwriting from the session and passes over the writer's option,
    so it is set around the write: in static mode all editions and the marker beside them would go.

    Rows are dealt to the buckets before they are written, so each bucket of an edition is one file
    whatever the number of tasks. Ids are one row per edition, so no bucket grows by a hot key; rows
    without an id would all share one bucket and are an error.
    """
    spark = silver.sparkSession
    buckets = int(_described(spark, table)["Num Buckets"])
    columns = spark.table(table).columns
    respondent = F.when(F.col(RESPONDENT).isNull(), F.raise_error(F.lit("a respondent has no id"))).otherwise(F.col(RESPONDENT))
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        (
            silver.withColumn(RESPONDENT, respondent)
            .select(*columns)
            .repartition(buckets, RESPONDENT)
            .sortWithinPartitions(EDITION, RESPONDENT)
            .write.mode("overwrite")
            .insertInto(table)
        )


def analyse(spark: SparkSession, table: str) -> None:
    """Row counts per edition and statistics of every measurable column, kept in the catalog.

    Spark compares the sizes with its broadcast limit and, with ``spark.sql.cbo.enabled``, orders
    joins by the row counts. Lists have no statistics.
    """
    fields = spark.table(table).schema.fields
    names = ", ".join(f"`{field.name}`" for field in fields if isinstance(field.dataType, MEASURED))
    spark.sql(f"ANALYZE TABLE {table} PARTITION ({EDITION}) COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {names}")


def edition_rows(spark: SparkSession, table: str) -> DataFrame:
    """(edition, rows) of an analysed table from the catalog, without reading a file of it."""
    years = sorted(int(row["partition"].split("=")[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    rows = []
    for year in years:
        described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({EDITION} = {year})").collect()
        stated = [row["data_type"] for row in described if row["col_name"] == "Partition Statistics"]
        counted = re.search(r"(\d+) rows", stated[0]) if stated else None
        rows.append((year, int(counted[1]) if counted else None))
    return spark.createDataFrame(rows, f"{EDITION} int, linhas bigint")


def column_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(column, nulls, least, greatest) of an analysed table from the catalog; text has no bounds."""
    rows = []
    for field in spark.table(table).schema.fields:
        if isinstance(field.dataType, MEASURED):
            told = {row["info_name"]: row["info_value"] for row in spark.sql(f"DESCRIBE EXTENDED {table} `{field.name}`").collect()}
            known = {name: None if told.get(name) == "NULL" else told.get(name) for name in ("num_nulls", "min", "max")}
            nulls = None if known["num_nulls"] is None else int(known["num_nulls"])
            rows.append((field.name, nulls, known["min"], known["max"]))
    return spark.createDataFrame(rows, "coluna string, nulos bigint, minimo string, maximo string")
