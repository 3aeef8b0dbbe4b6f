"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

Each source has a mean repetition rate, its target number of rows divided by its number of rows. A
document's number of copies is drawn from the Poisson distribution of that mean by inverting it at a
number hashed from the seed and the document's id, so the draw repeats whenever a task runs again.
Documents are exploded by their count and ordered by a hash, which is a random order of all rows.

Defined results: rows without source are a source of their own. Rows that share an id and source have the same number
of copies; a NULL id counts as one id. Without explicit weights a source weighs its number of rows
to the power ``alpha``. Explicit weights need not add up to 1; sources they do not name are left out, as a
weight of zero asks for. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, fresh, salted_join

SEED = "mix-1"
ALPHA = 0.7
# A mean above this is drawn as a sum of equal parts, each from its own hash.
PART_MEAN = 16
# Probability of more copies than this in one part: below 1e-28.
MOST = 80
# Sources up to this number are sent to all tasks; beyond it the join is salted.
SMALL = 10_000


def _hashed(*parts: Column) -> Column:
    """An integer from 0 to 2**52 - 1."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = ALPHA, size: float = 1.0, source: str = "source") -> DataFrame:
    """``source_key, mean`` of every source; the expected rows in all are ``size`` times those of the input."""
    counts = docs.groupBy(column(source).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        weight = F.pow(F.col("n"), F.lit(float(alpha)))
    else:
        pairs = [F.lit(x) for name, value in weights.items() for x in (name, float(value))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0)) if pairs else F.lit(0.0)
    counts = counts.withColumn("weight", weight)
    whole = counts.groupBy().agg(F.sum("weight").alias("weights"), F.sum("n").alias("rows"))
    whole = whole.first()
    share = F.col("weight") * F.lit(float(size) * (whole["rows"] or 0) / (whole["weights"] or 1.0))
    return counts.select(_source_key(F.col("source")).alias("source_key"), (share / F.col("n")).alias("mean"))


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, ... ``MOST``."""
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("sums"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        return F.struct(term.alias("term"), F.array_append(state["sums"], F.element_at(state["sums"], -1) + term).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step, lambda state: state["sums"])


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    alpha: float = ALPHA,
    size: float = 1.0,
    seed: str = SEED,
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in random order.

    Columns ``copy`` (from 1) and ``order_key`` are added; columns of those names are replaced.
    """
    plan = rates(docs, weights, alpha, size, source)
    parts = F.greatest(F.ceil(F.col("mean") / PART_MEAN), F.lit(1))
    plan = plan.withColumn("parts", parts).withColumn("sums", _distribution(F.col("mean") / F.col("parts")))
    columns = [name for name in docs.columns if name.lower() not in ("copy", "order_key")]
    row = fresh(docs, "row")
    keyed = docs.select(
        F.struct(*map(column, columns)).alias(row),
        _source_key(column(source)).alias("source_key"),
        F.coalesce(column(doc_id).cast("string"), F.lit("")).alias("id"),
    )
    if plan.limit(SMALL + 1).count() <= SMALL:
        keyed = keyed.join(F.broadcast(plan), "source_key")
    else:
        keyed = salted_join(keyed, plan, ["source_key"], F.col("id"))

    def draw(part: Column) -> Column:
        at = (_hashed(F.lit(seed), part.cast("string"), F.col("id"), F.col("source_key")) + 0.5) / F.lit(2.0**52)
        return F.size(F.filter(F.col("sums"), lambda sum_: sum_ <= at))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("parts").cast("int")), F.lit(0), lambda total, part: total + draw(part))
    copied = keyed.withColumn("copies", copies).where("copies > 0").select(row, "id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    order = _hashed(F.lit(seed), F.lit("order"), F.col("copy").cast("string"), F.col("id"))
    copied = copied.select(row, "copy", order.alias("order_key"))
    spread = copied.repartition(F.col("order_key")).sortWithinPartitions("order_key")
    return spread.select(f"{row}.*", "copy", "order_key")


def mixed_sql(alpha: float = ALPHA, seed: str = SEED) -> str:
    """DuckDB SQL for the rows of ``mixed`` over ``documents`` with one draw for each document (means up to ``PART_MEAN``)."""
    return f"""
    WITH counts AS (
        SELECT source, count(*) AS n, pow(count(*), {alpha}) AS weight FROM documents GROUP BY source
    ), means AS (
        SELECT source, n, weight * (1.0 * (SELECT sum(n) FROM counts) / (SELECT sum(weight) FROM counts)) / n AS mean FROM counts
    ), steps AS (
        SELECT source, k, exp(-mean) * pow(mean, k) / gamma(k + 1) AS term FROM means, range({MOST + 1}) AS r(k)
    ), sums AS (
        SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS reached FROM steps
    ), drawn AS (
        SELECT d.*, (('0x' || substr(md5('{seed}:1:' || d.doc_id || ':=' || d.source), 1, 13))::BIGINT + 0.5) / pow(2.0, 52) AS at
        FROM documents d
    ), counted AS (
        SELECT w.doc_id, w.text, w.lang, w.source, w.n_chars, count(s.k)::INTEGER AS copies
        FROM drawn w JOIN sums s ON s.source = w.source AND s.reached <= w.at
        GROUP BY ALL
    ), copied AS (
        SELECT *, unnest(range(1, copies + 1))::INTEGER AS copy FROM counted
    )
    SELECT doc_id, text, lang, source, n_chars, copy,
        ('0x' || substr(md5('{seed}:order:' || copy || ':' || doc_id), 1, 13))::BIGINT AS order_key
    FROM copied
    """
