"""Numbering rows inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_in_group(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    name: str,
    width: int = 1_000_000,
    within: Sequence[str] = (),
) -> DataFrame:
    """1-based number of each row in its group, ordered by (``within``, ``position``).

    The group is cut into ranges of ``position``; rows are numbered inside each range and shifted
    by the size of the ranges before it, so no task orders more than one range of a group. Keys
    must not be NULL and ``position`` must be unique inside (keys, within).
    """
    keys, within = list(keys), list(within)
    cut = df.withColumn("_range", F.floor(F.col(position) / F.lit(width)))
    slot = [*keys, *within, "_range"]
    before = (
        Window.partitionBy(*keys)
        .orderBy(*within, "_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*slot)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    inside = F.row_number().over(Window.partitionBy(*slot).orderBy(position))
    return (
        cut.withColumn("_inside", inside)
        .join(offsets, slot)
        .withColumn(name, F.col("_inside") + F.col("_shift"))
        .drop("_inside", "_shift", "_range")
    )


def numbered_copies(df: DataFrame, times: str, name: str, keys: Sequence[str], width: int = 10_000) -> DataFrame:
    """Each row ``times`` times, numbered from 1 in ``name``; rows with fewer than one are left out.

    The numbers of a row's chunks of ``width`` copies are listed, one for most rows, dealt by ``keys``
    over all shuffle partitions and counted out there, so no task writes all copies of a row and the
    rows are computed once. The deal has a fixed number of partitions: by its few bytes adaptive
    execution would put the chunks of one row back into one task.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.floor((F.col(times) - 1) / width).cast("long")
    chunks = df.where(F.col(times) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("_chunk") * width
    within = F.sequence(first + 1, F.least(first + width, F.col(times).cast("long")))
    return chunks.repartition(partitions, *keys, "_chunk").withColumn(name, F.explode(within)).drop("_chunk")


def first_of_each(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total up to identical rows.

    The filter on the row number is pushed into the map tasks, which send one row per key each.
    """
    numbered = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return numbered.where(F.col("_rank") == 1).drop("_rank")
