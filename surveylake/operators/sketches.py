"""Segment statistics as stored, mergeable state: counts, sums and quantile sketches.

A state row is as large whatever its segment holds, and states of the same segment add up. Statistics
over any union of editions, regions or exports come from stored states without reading answers again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.functions.text import enough
from surveylake.operators.segments import PERCENTILES

# Items a sketch keeps on its lowest level; the error of a rank is below ``RANK_ERROR`` of the rows.
SKETCH_ITEMS = 2048
RANK_ERROR = 0.005


def segment_states(df: DataFrame, keys: Sequence[str], measure: str = "salario_medio_mensal", items: int = SKETCH_ITEMS) -> DataFrame:
    """Keys, ``n``, ``total`` and ``sketch`` of the measure per segment; NULL measures are left out."""
    value = F.col(measure).cast("double")
    return df.where(value.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.kll_sketch_agg_double(value, F.lit(items)).alias("sketch")
    )


def cut_states(
    df: DataFrame,
    keys: Sequence[str],
    cuts: Mapping[str, Sequence[str]],
    measure: str = "salario_medio_mensal",
    dimension_as: str = "dimensao",
    items: int = SKETCH_ITEMS,
) -> DataFrame:
    """States of several cuts in one pass: keys, the cut's name and an array with its categories."""
    pairs = [
        F.struct(F.lit(name).alias(dimension_as), F.array(*[F.col(column).cast("string") for column in columns]).alias("categorias"))
        for name, columns in cuts.items()
    ]
    stacked = df.where(F.col(measure).isNotNull()).select(*keys, measure, F.inline(F.array(*pairs)))
    return segment_states(stacked, [*keys, dimension_as, "categorias"], measure, items)


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States added up over everything that ``keys`` leave out."""
    return states.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.kll_merge_agg_double("sketch").alias("sketch")
    )


def state_stats(
    states: DataFrame,
    percentiles: Mapping[str, float] = PERCENTILES,
    min_n: int = 30,
    count_as: str = "respondentes",
    mean_as: str = "salario_medio",
    flag_as: str = "amostra_suficiente",
) -> DataFrame:
    """The statistics of :func:`~surveylake.operators.segments.segment_stats` from states."""
    kept = [name for name in states.columns if name not in ("n", "total", "sketch")]
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in percentiles.values()]))
    return states.withColumn("_found", found).select(
        *kept,
        F.col("n").alias(count_as),
        F.round(F.col("total") / F.col("n"), 2).alias(mean_as),
        *[F.round(F.col("_found")[index], 2).alias(name) for index, name in enumerate(percentiles)],
        enough(F.col("n"), min_n).alias(flag_as),
    )
