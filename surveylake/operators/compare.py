"""Comparisons over aggregated tables: shares, reference groups, editions, ordered lists.

The inputs are segment tables (one row per segment), so the windows here see few rows however
many respondents there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.functions.text import ordinal_of, percentage


def share_within(
    df: DataFrame, value: str, partition: Sequence[str], name: str, digits: int = 2
) -> DataFrame:
    """Percentage of each row in the total of its partition."""
    total = F.sum(value).over(Window.partitionBy(*partition))
    return df.withColumn(name, percentage(F.col(value), total, digits))


def reference_value(
    df: DataFrame,
    value: str,
    category: str,
    reference: str,
    partition: Sequence[str],
    name: str,
) -> DataFrame:
    """Add the value of the reference category to every row of its partition."""
    of_reference = F.when(F.col(category) == reference, F.col(value))
    return df.withColumn(name, F.max(of_reference).over(Window.partitionBy(*partition)))


def relative_to(value: Column, reference: Column, kind: str = "pct", digits: int = 2) -> Column:
    """``pct``: difference in percent · ``index``: reference = 100 · ``ratio``: multiple of it."""
    if kind == "pct":
        result = F.try_divide((value - reference) * 100.0, reference)
    elif kind == "index":
        result = F.try_divide(value * 100.0, reference)
    elif kind == "ratio":
        result = F.try_divide(value, reference)
    else:
        raise ValueError(f"unknown comparison: {kind}")
    return F.round(result, digits)


def gap_to_reference(
    df: DataFrame,
    value: str,
    category: str,
    reference: str,
    partition: Sequence[str],
    name: str,
    kind: str = "pct",
    digits: int = 2,
    keep_reference_as: str | None = None,
) -> DataFrame:
    """Compare every row with the reference category of its partition."""
    holder = keep_reference_as or "_reference"
    compared = reference_value(df, value, category, reference, partition, holder).withColumn(
        name, relative_to(F.col(value), F.col(holder), kind, digits)
    )
    return compared if keep_reference_as else compared.drop(holder)


def premium_vs_first(
    df: DataFrame,
    value: str,
    partition: Sequence[str],
    category: str,
    order: Sequence[str],
    name: str,
    kind: str = "pct",
    digits: int = 1,
) -> DataFrame:
    """Compare every level with the first level present in its partition.

    The base is the first level that survived earlier filters, not necessarily the first one of
    ``order``.
    """
    # Levels outside the order share an ordinal; the name decides among them.
    levels = Window.partitionBy(*partition).orderBy(ordinal_of(F.col(category), order), category)
    return df.withColumn(
        name, relative_to(F.col(value), F.first(value).over(levels), kind, digits)
    )


def editions_side_by_side(
    df: DataFrame,
    keys: Sequence[str],
    edition: str,
    columns: Mapping[str, tuple[int, str]],
    agg: str = "max",
    digits: int | None = None,
) -> DataFrame:
    """One column per (edition, measure): ``{"pct_2023": (2023, "pct"), …}``, in one aggregation.

    ``max`` leaves an absent edition NULL, ``sum`` makes it zero.
    """
    aggregates = []
    for name, (year, measure) in columns.items():
        of_year = F.col(edition) == year
        if agg == "sum":
            picked = F.sum(F.when(of_year, F.col(measure)).otherwise(F.lit(0)))
        else:
            picked = F.max(F.when(of_year, F.col(measure)))
        aggregates.append((F.round(picked, digits) if digits is not None else picked).alias(name))
    return df.groupBy(*keys).agg(*aggregates)


def top_k(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[Column],
    k: int,
    latest_of: str | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group, optionally of the group's latest edition only.

    ``order`` must end in a unique key. Spark limits each group in the map tasks before the
    shuffle, so a hot group sends at most ``k`` rows per task. Rows of older editions sort after
    the latest one and are dropped from the at most ``k`` rows kept.
    """
    order = [F.col(latest_of).desc(), *order] if latest_of else list(order)
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    ).where(F.col("_rank") <= k)
    if latest_of:
        newest = F.max(latest_of).over(Window.partitionBy(*partition))
        ranked = ranked.withColumn("_newest", newest).where(F.col("_newest") == F.col(latest_of))
        ranked = ranked.drop("_newest")
    return ranked.drop("_rank")


def arg_max(
    df: DataFrame, partition: Sequence[str], order: Sequence[Column], keep: Sequence[str]
) -> DataFrame:
    """The ``keep`` columns of the row with the greatest ``order`` per group, as an aggregate."""
    best = F.max_by(F.struct(*keep), F.struct(*order)).alias("_best")
    return df.groupBy(*partition).agg(best).select(*partition, "_best.*")


def ordered_list(df: DataFrame, values: Sequence[str], name: str, position: str = "posicao") -> DataFrame:
    """A literal, ordered one-column table."""
    spark = df.sparkSession
    literal = F.array(*[F.lit(value) for value in values])
    return spark.range(1).select(F.posexplode(literal).alias(position, name)).withColumn(
        position, F.col(position) + 1
    )


def reindex(
    df: DataFrame, category: str, ordered_values: Sequence[str], position: str = "posicao"
) -> DataFrame:
    """Exactly the given categories with their position; absent ones get NULL measures."""
    return ordered_list(df, ordered_values, category, position).join(df, category, "left")


def in_order(df: DataFrame, category: str, order: Sequence[str], *before: Column) -> DataFrame:
    """Sort by an ordinal category after the ``before`` columns."""
    return df.orderBy(*before, ordinal_of(F.col(category), order))
