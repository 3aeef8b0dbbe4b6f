"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.session import scratch_path


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it."""
    taken = {existing.lower() for existing in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(name: str = "text") -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(column(name), F.lit(""))


def row_key(doc_id: Column, text: Column) -> Column:
    """A 32-byte key of a row's id and text: never NULL, equal for repeated rows only.

    It depends on the content alone, so a task that runs again after a lost executor finds it again.
    """
    tag = F.coalesce(F.concat(F.lit("="), doc_id.cast("string")), F.lit("-"))
    return F.unhex(F.sha2(F.concat_ws("\x1f", tag, F.coalesce(text, F.lit("\x1e"))), 256))


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: Column, salts: int = 64, how: str = "inner"
) -> DataFrame:
    """Join a large side on keys of which one may hold a third of its rows.

    The right side has one row for each key and is repeated ``salts`` times; ``spread`` deals the
    left rows of a key over the repeats, so the hottest key reaches ``salts`` tasks.
    """
    salt = fresh(left, "salt")
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)))
    repeated = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return dealt.join(repeated, [*keys, salt], how).drop(salt)
