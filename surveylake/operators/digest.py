"""Tables compared by order-independent digests: buckets of rows first, rows of differing buckets only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.operators.quality import table_difference

BUCKETS = 65_536
# Buckets under one node of the upper level.
FAN = 256


def _hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a row, in which a NULL differs from any value and any other NULL."""
    values = [F.col(f"`{name}`") for name in sorted(columns)]
    absent = F.concat_ws("", *[value.isNull().cast("string") for value in values])
    return F.xxhash64(absent, *values), F.xxhash64(*values, absent, F.lit("second"))


def _summed(hash_: Column) -> Column:
    """Sum of hashes as an exact decimal: independent of the order, and rows that repeat do not cancel."""
    return F.sum(hash_.cast("decimal(20)"))


def bucket_digests(df: DataFrame, columns: Sequence[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, its number of rows and its digest; one row for each bucket, however large the table.

    Stored beside a table, it lets the table be compared elsewhere without its rows.
    """
    first, second = _hashes(columns or df.columns)
    hashed = df.select(first.alias("_first"), second.alias("_second"))
    return hashed.groupBy(F.pmod("_first", F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("linhas"), F.concat_ws("/", _summed(F.col("_first")), _summed(F.col("_second"))).alias("digest")
    )


def partition_digests(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``key``, rows and digest of each of its values, such as the editions of a table."""
    first, second = _hashes([name for name in columns or df.columns if name != key])
    return df.select(key, first.alias("_first"), second.alias("_second")).groupBy(key).agg(
        F.count(F.lit(1)).alias("linhas"), F.concat_ws("/", _summed(F.col("_first")), _summed(F.col("_second"))).alias("digest")
    )


def differing_buckets(left: DataFrame, right: DataFrame, fan: int = FAN) -> DataFrame:
    """Numbers of the buckets that differ; buckets below equal nodes of the upper level are not compared."""

    def node(buckets: DataFrame, side: str) -> DataFrame:
        inner = F.concat_ws("|", F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("bucket").cast("string"), 20, "0"), "linhas", "digest"))))
        return buckets.groupBy(F.floor(F.col("bucket") / fan).alias("node")).agg(F.sha2(inner, 256).alias(side))

    above = node(left, "_left").join(node(right, "_right"), "node", "full")
    open_ = above.where(~F.col("_left").eqNullSafe(F.col("_right"))).select("node")

    def below(buckets: DataFrame, side: str) -> DataFrame:
        return buckets.withColumn("node", F.floor(F.col("bucket") / fan)).join(open_, "node", "left_semi").select(
            "bucket", F.concat_ws(":", "linhas", "digest").alias(side)
        )

    both = below(left, "_left").join(below(right, "_right"), "bucket", "full")
    return both.where(~F.col("_left").eqNullSafe(F.col("_right"))).select("bucket")


def digest_difference(left: DataFrame, right: DataFrame, buckets: int = BUCKETS, fan: int = FAN) -> DataFrame:
    """The rows of :func:`~surveylake.operators.quality.table_difference`, of which only differing buckets are shuffled."""
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError(f"different columns: {sorted(set(columns) ^ set(right.columns))}")
    right = right.select(*[F.col(f"`{name}`") for name in columns])
    open_ = differing_buckets(bucket_digests(left, buckets=buckets), bucket_digests(right, buckets=buckets), fan)

    def rows(df: DataFrame) -> DataFrame:
        place = F.pmod(_hashes(columns)[0], F.lit(buckets))
        # The numbers of buckets are bounded by ``buckets``, so they go to the rows and not the rows to them.
        return df.withColumn("_bucket", place).join(F.broadcast(open_), F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")

    return table_difference(rows(left), rows(right))
