"""Segment statistics: counts, means, percentiles, rates and multi-select adoption.

Every operator is DataFrame → DataFrame, aggregates before it shuffles, and leaves NULL measures
out unless it says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.functions.text import enough, marked, marked_or_zero, percentage

PERCENTILES = {"salario_mediano": 0.5, "salario_p25": 0.25, "salario_p75": 0.75}

# Buckets per natural-log unit of the measure in the exact percentile; one is 0.005 % wide.
BUCKETS_PER_LOG_UNIT = 20_000
# Parts of a bucket that holds a rank.
PARTS = 65_536


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality on the key columns of two aliased sides."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def percentile_columns(
    measure: str | Column, percentiles: Mapping[str, float], accuracy: int
) -> Column:
    """One sketch per segment that answers all the percentiles asked for."""
    points = F.array(*[F.lit(float(p)) for p in percentiles.values()])
    return F.percentile_approx(measure, points, F.lit(accuracy))


def with_percentiles(
    df: DataFrame, sketch: str, percentiles: Mapping[str, float], digits: int = 2
) -> DataFrame:
    """Replace the answer array of :func:`percentile_columns` by one rounded column each."""
    for index, name in enumerate(percentiles):
        df = df.withColumn(name, F.round(F.col(sketch)[index], digits))
    return df.drop(sketch)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], measure: str, percentiles: Mapping[str, float]
) -> DataFrame:
    """Exact discrete percentiles per segment, safe for a segment holding most of the rows.

    Rows are first counted per (segment, value): banded measures collapse in the map tasks. The
    values of a segment are cut into ordered buckets of equal relative width, and the bucket that
    holds a rank into ``PARTS`` parts of equal width between its own least and greatest value. Both
    numbers are bounded by the range of a double and not by the data, and both are counted before
    they are shuffled, so only one narrow part is ever sorted, also where all values of a segment
    are close together. Values keep their type; buckets only use its order. Returns the keys,
    ``n``, ``total`` and one column per percentile.
    """
    keys = list(keys)
    number = F.col("_value").cast("double")
    scaled = F.signum(number) * F.floor(F.log1p(F.abs(number)) * F.lit(BUCKETS_PER_LOG_UNIT))
    # NaN shares the last bucket with infinity and orders after it, as in Spark sorts.
    bucket = F.when(F.isnan(number), F.lit(2**63 - 1)).otherwise(F.floor(scaled))
    histogram = (
        df.where(F.col(measure).isNotNull())
        .groupBy(*keys, F.col(measure).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", bucket)
    )
    in_segment = Window.partitionBy(*keys)
    in_order = in_segment.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    buckets = (
        histogram.groupBy(*keys, "_bucket")
        .agg(
            F.sum("_n").alias("_in"),
            F.sum(number * F.col("_n")).alias("_sum"),
            F.min(number).alias("_low"),
            F.max(number).alias("_high"),
        )
        .withColumn("_through", F.sum("_in").over(in_order))
        .withColumn("n", F.sum("_in").over(in_segment))
        .withColumn("total", F.sum("_sum").over(in_segment))
    )
    ranks = F.array(
        *[
            F.struct(
                F.lit(index).alias("_which"),
                F.greatest(F.lit(1).cast("long"), F.ceil(F.lit(float(p)) * F.col("n"))).alias("_rank"),
            )
            for index, p in enumerate(percentiles.values())
        ]
    )
    targets = (
        buckets.withColumn("_before", F.col("_through") - F.col("_in"))
        .select(*keys, "_bucket", "_before", "_through", "_low", "_high", "n", "total", F.inline(ranks))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_through")))
    )
    share = F.try_divide(number - F.col("_low"), F.col("_high") - F.col("_low"))
    # Infinite ends and equal values leave no share; NaN comes last.
    part = (
        F.when(F.isnan(number), F.lit(PARTS + 1))
        .when(share.isNull() | F.isnan(share), F.when(F.col("_low") < number, F.lit(PARTS)).otherwise(F.lit(0)))
        .otherwise(F.floor(share * F.lit(PARTS)))
        .cast("int")
    )
    rows = (
        histogram.alias("h")
        .join(targets.alias("t"), _same_keys("h", "t", [*keys, "_bucket"]))
        .select(
            *[F.col(f"h.{key}").alias(key) for key in keys],
            "_value", "_n", "_which", "_before", "_rank", "n", "total", part.alias("_part"),
        )
    )
    target = [*keys, "_which", "_before", "_rank", "n", "total"]
    in_target = Window.partitionBy(*keys, "_which").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        rows.groupBy(*target, "_part")
        .agg(F.sum("_n").alias("_in"), F.count(F.lit(1)).alias("_values"), F.min("_value").alias("_only"))
        .withColumn("_through", F.col("_before") + F.sum("_in").over(in_target))
        .withColumn("_before", F.col("_through") - F.col("_in"))
        .where((F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_through")))
    )
    in_part = (
        Window.partitionBy(*keys, "_which")
        .orderBy("_value")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    inside = (
        rows.select(*keys, "_which", "_part", "_value", "_n").alias("h")
        .join(
            parts.where("_values > 1").select(*keys, "_which", "_part", "_before", "_rank", "n", "total").alias("t"),
            _same_keys("h", "t", [*keys, "_which", "_part"]),
        )
        .select(
            *[F.col(f"h.{key}").alias(key) for key in keys],
            F.col("h._which").alias("_which"), "_value", "_n", "_before", "_rank", "n", "total",
        )
        .withColumn("_reached", F.col("_before") + F.sum("_n").over(in_part))
        .where(F.col("_reached") >= F.col("_rank"))
        .groupBy(*keys, "_which", "n", "total")
        .agg(F.min("_value").alias("_value"))
    )
    # A part of one value, as with banded measures, is the answer itself.
    alone = parts.where("_values = 1").select(*keys, "_which", "n", "total", F.col("_only").alias("_value"))
    answers = [
        F.min(F.when(F.col("_which") == index, F.col("_value"))).alias(name)
        for index, name in enumerate(percentiles)
    ]
    return alone.unionByName(inside).groupBy(*keys).agg(
        F.max("n").alias("n"), F.max("total").alias("total"), *answers
    )


def segment_stats(
    df: DataFrame,
    keys: Sequence[str],
    measure: str = "salario_medio_mensal",
    percentiles: Mapping[str, float] = PERCENTILES,
    min_n: int = 30,
    exact: bool = False,
    accuracy: int = 10_000,
    count_as: str = "respondentes",
    mean_as: str = "salario_medio",
    flag_as: str = "amostra_suficiente",
) -> DataFrame:
    """Count, mean, percentiles and the sample-size flag of a measure per segment.

    The default keeps one mergeable percentile sketch per segment (rank error 1/accuracy, size
    independent of the rows); ``exact=True`` ranks every value.
    """
    keys = list(keys)
    if exact:
        stats = exact_percentiles(df, keys, measure, percentiles).select(
            *keys,
            F.col("n").alias(count_as),
            F.round(F.col("total") / F.col("n"), 2).alias(mean_as),
            *[F.round(F.col(name), 2).alias(name) for name in percentiles],
        )
    else:
        stats = with_percentiles(
            df.where(F.col(measure).isNotNull())
            .groupBy(*keys)
            .agg(
                F.count(F.lit(1)).alias(count_as),
                F.round(F.avg(measure), 2).alias(mean_as),
                percentile_columns(measure, percentiles, accuracy).alias("_sketch"),
            ),
            "_sketch",
            percentiles,
        )
    return stats.withColumn(flag_as, enough(F.col(count_as), min_n))


def multi_cut_stats(
    df: DataFrame,
    keys: Sequence[str],
    cuts: Mapping[str, str],
    measure: str = "salario_medio_mensal",
    dimension_as: str = "dimensao",
    category_as: str = "categoria",
    **options,
) -> DataFrame:
    """The same statistics for several cuts, stacked as (keys, dimension, category).

    One pass: each row is counted once per cut it has a value for, and the map tasks combine the
    copies again before anything is shuffled.
    """
    pairs = [
        F.struct(F.lit(name).alias(dimension_as), F.col(column).cast("string").alias(category_as))
        for name, column in cuts.items()
    ]
    stacked = (
        df.where(F.col(measure).isNotNull())
        .select(*keys, measure, F.inline(F.array(*pairs)))
        .where(F.col(category_as).isNotNull())
    )
    return segment_stats(
        stacked, [*keys, dimension_as, category_as], measure, **options
    )


def rate_among_answered(
    df: DataFrame,
    keys: Sequence[str],
    flags: Mapping[str, Column],
    null_as_false: bool = False,
    digits: int = 2,
) -> DataFrame:
    """Percentage of true per segment.

    NULL answers leave the denominator; with ``null_as_false`` they stay in it as "no".
    """
    mark = marked_or_zero if null_as_false else marked
    return df.groupBy(*keys).agg(
        *[
            F.round(F.avg(mark(flag)) * 100, digits).alias(name)
            for name, flag in flags.items()
        ]
    )


def ratio_of_sums(
    df: DataFrame,
    keys: Sequence[str],
    ratios: Mapping[str, tuple[str, str]],
    sums: Mapping[str, str] | None = None,
    digits: int = 2,
) -> DataFrame:
    """``100 * sum(a) / sum(b)`` per segment, NULL where the base is zero; plus plain sums."""
    return df.groupBy(*keys).agg(
        *[F.sum(column).alias(name) for name, column in (sums or {}).items()],
        *[
            percentage(F.sum(part), F.sum(base), digits).alias(name)
            for name, (part, base) in ratios.items()
        ],
    )


def adoption(
    df: DataFrame,
    keys: Sequence[str],
    blocks: Mapping[str, str],
    dedupe: bool = True,
    category_as: str = "categoria",
    item_as: str = "tecnologia",
    users_as: str = "usuarios",
    base_as: str = "base_respondentes",
    rate_as: str = "pct_adocao",
) -> DataFrame:
    """Adoption of every item of the multi-select blocks among those who answered the block.

    All blocks in one scan and one shuffle: a respondent yields one row per chosen item and one
    NULL item per answered block, so the count of NULL items is the base of that block. The base
    is spread over the items after aggregation, where a block has as many rows as it has items.
    """
    def block_rows(label: str, column: str) -> Column:
        items = F.filter(F.col(column), lambda item: item.isNotNull() & (item != ""))
        items = F.array_distinct(items) if dedupe else items
        with_base = F.concat(F.array(F.lit(None).cast("string")), items)
        return F.transform(
            F.coalesce(with_base, F.array().cast("array<string>")),
            lambda item: F.struct(F.lit(label).alias(category_as), item.alias(item_as)),
        )

    rows = [block_rows(label, column) for label, column in blocks.items()]
    counted = (
        df.select(*keys, F.inline(F.concat(*rows)))
        .groupBy(*keys, category_as, item_as)
        .agg(F.count(F.lit(1)).alias(users_as))
    )
    in_block = Window.partitionBy(*keys, category_as)
    base = F.max(F.when(F.col(item_as).isNull(), F.col(users_as))).over(in_block)
    return (
        counted.withColumn(base_as, base)
        .where(F.col(item_as).isNotNull())
        .withColumn(rate_as, percentage(F.col(users_as), F.col(base_as)))
    )


def adoption_with_base_join(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    item_as: str = "tecnologia",
    users_as: str = "usuarios",
    base_as: str = "base_respondentes",
) -> DataFrame:
    """Item counts of one block joined with the separately aggregated answered base.

    As in :func:`adoption`, a repeated item of one respondent counts once and NULL keys are a
    segment. Both sides are aggregates; Spark broadcasts the base when its measured size allows it.
    """
    answered = df.where(F.col(column).isNotNull())
    base = answered.groupBy(*keys).agg(F.count(F.lit(1)).alias(base_as))
    items = (
        answered.select(*keys, F.explode(F.array_distinct(column)).alias(item_as))
        .where(F.col(item_as).isNotNull() & (F.col(item_as) != ""))
        .groupBy(*keys, item_as)
        .agg(F.count(F.lit(1)).alias(users_as))
    )
    return items.alias("i").join(base.alias("b"), _same_keys("i", "b", keys)).select("i.*", f"b.{base_as}")
