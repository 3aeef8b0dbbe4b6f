"""Header tables: one row per column per edition, named, made unique and matched to fields.

A header table has ``edition``, ``pos`` and ``raw``; it may come from file headers or from
long-format data where the question text is a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.functions.headers import column_name, is_junk, is_non_answer, option_label
from surveylake.functions.rules import CANONICAL_FIELDS, MULTI_SELECT_BLOCKS, FieldSpec
from surveylake.operators.ranking import number_in_group


def header_table(spark: SparkSession, headers: Mapping[str, Sequence[str]]) -> DataFrame:
    """Header table of files already opened: edition → its raw column names."""
    rows = [
        (edition, pos, raw) for edition, names in headers.items() for pos, raw in enumerate(names)
    ]
    return spark.createDataFrame(rows, "edition string, pos int, raw string")


def _taken_suffixes(df: DataFrame, edition: str, name: str) -> DataFrame:
    """(edition, name, _gap, _upto): ``_upto`` suffixes of the name are taken below its ``_gap``-th free one.

    The i-th of the suffixes taken, u, has u - i free ones from 2 on up to it, so suffixes in a row share a gap.
    """
    parts = F.regexp_extract(name, r"^(.*)_([1-9]\d*)$", 1), F.regexp_extract(name, r"^(.*)_([1-9]\d*)$", 2).try_cast("long")
    suffixes = df.select(edition, parts[0].alias(name), parts[1].alias("_suffix")).where(F.col("_suffix") >= 2).distinct()
    ranked = number_in_group(suffixes, [edition, name], "_suffix", "_upto")
    gap = (F.col("_suffix") - F.col("_upto") + 1).alias("_gap")
    return ranked.groupBy(edition, name, gap).agg(F.max("_upto").alias("_upto"))


def unique_names(df: DataFrame, edition: str = "edition", pos: str = "pos", name: str = "name") -> DataFrame:
    """Suffix repeated names of an edition with ``_2``, ``_3`` …, skipping names already taken.

    The n-th column of a name gets n plus the number of suffixes taken up to there: a running
    maximum over the gaps and columns of a name in one order, in which nothing is collected.
    """
    numbered = number_in_group(df, [edition, name], pos, "_nth")
    places = numbered.withColumns({"_gap": F.lit(None).cast("long"), "_upto": F.lit(None).cast("long")}).unionByName(
        _taken_suffixes(df, edition, name), allowMissingColumns=True
    )
    order = Window.partitionBy(edition, name).orderBy(F.coalesce("_gap", "_nth"), F.col("_gap").isNull())
    skipped = F.coalesce(F.max("_upto").over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    suffixed = F.concat_ws("_", F.col(name), (F.col("_nth") + skipped).cast("string"))
    return (
        places.withColumn("_unique", F.when(F.col("_nth") == 1, F.col(name)).otherwise(suffixed))
        .where(F.col("_gap").isNull())
        .drop(name, "_nth", "_gap", "_upto")
        .withColumnRenamed("_unique", name)
    )


def name_headers(headers: DataFrame) -> DataFrame:
    """Raw headers → unique column names, with a flag for export junk."""
    return unique_names(headers.withColumn("name", column_name(F.col("raw")))).withColumn("junk", is_junk(F.col("name")))


def _priority(name: Column, spec: FieldSpec) -> Column:
    """Index of the first pattern that matches; NULL if none does or an exclusion applies."""
    priority = F.lit(None).cast("int")
    for index, pattern in reversed(list(enumerate(spec.patterns))):
        priority = F.when(name.rlike(pattern), F.lit(index)).otherwise(priority)
    if spec.exclude:
        excluded = name.rlike("|".join(f"(?:{pattern})" for pattern in spec.exclude))
        priority = F.when(~excluded, priority)
    return priority


def _candidates(named: DataFrame, specs: Sequence[FieldSpec], keep: int) -> DataFrame:
    """The best ``keep`` columns per (edition, field): pattern order, then shortest, then first.

    Every header is tested against the fixed patterns as literals, in one pass and without a join.
    """
    name = F.col("name")
    matches = [
        F.when(
            _priority(name, spec).isNotNull(),
            F.struct(
                F.lit(index).alias("slot"),
                F.lit(spec.name).alias("field"),
                _priority(name, spec).alias("priority"),
            ),
        )
        for index, spec in enumerate(specs)
    ]
    found = named.where(~F.col("junk")).select(
        "edition", "pos", "name", F.inline(F.array_compact(F.array(*matches)))
    )
    best = Window.partitionBy("edition", "slot").orderBy("priority", F.length("name"), "pos")
    return found.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= keep)


def resolve_fields(
    named: DataFrame, specs: Sequence[FieldSpec] = tuple(CANONICAL_FIELDS)
) -> DataFrame:
    """(edition, field, name): the column of each canonical field, a column serving only once.

    Fields choose in their fixed order, so a field can lose at most one candidate to each other
    field. As many candidates as there are fields are therefore enough for the exact answer, and
    they bound the list folded per edition.
    """
    candidates = _candidates(named, specs, keep=len(specs))
    ordered = F.array_sort(F.collect_list(F.struct("slot", "_rank", "field", "name")))
    nothing = F.array().cast("array<struct<slot:int,_rank:int,field:string,name:string>>")
    chosen = F.aggregate(
        "_ordered",
        nothing,
        lambda taken, candidate: F.when(
            F.exists(
                taken,
                lambda t: (t["slot"] == candidate["slot"]) | (t["name"] == candidate["name"]),
            ),
            taken,
        ).otherwise(F.array_append(taken, candidate)),
    )
    return (
        candidates.groupBy("edition")
        .agg(ordered.alias("_ordered"))
        .select("edition", F.inline(chosen))
        .select("edition", "field", "name")
    )


def resolve_blocks(
    named: DataFrame, specs: Sequence[FieldSpec] = tuple(MULTI_SELECT_BLOCKS)
) -> DataFrame:
    """(edition, block, name, label, technology): the option columns of each multi-select block.

    The parent question is found by its meaning; its code then leads to the options, whose names
    carry only the item. Options that name no technology stay in the list with
    ``technology = false``: they count as an answer.
    """
    parents = _candidates(named, specs, keep=1).select(
        "edition",
        F.col("field").alias("block"),
        F.regexp_extract("name", r"^([^_]+_[^_]+)", 1).alias("_code"),
    )
    options = (
        named.where(~F.col("junk"))
        .withColumn("_code", F.regexp_extract("name", r"^([^_]+_[^_]+)_\d+_", 1))
        .where(F.col("_code") != "")
        .select("edition", "_code", "name")
    )
    return options.join(parents.where(F.col("_code") != ""), ["edition", "_code"]).select(
        "edition",
        "block",
        "name",
        option_label(F.col("name")).alias("label"),
        (~is_non_answer(F.col("name"))).alias("technology"),
    )


def resolution_report(
    named: DataFrame,
    resolved: DataFrame,
    specs: Sequence[FieldSpec] = tuple(CANONICAL_FIELDS),
) -> DataFrame:
    """(edition, field, name, status) for every field of every edition, absent ones included."""
    names = F.explode(F.array(*[F.lit(spec.name) for spec in specs])).alias("field")
    wanted = named.select("edition").distinct().select("edition", names)
    status = F.when(F.col("name").isNotNull(), F.lit("resolvido")).otherwise(F.lit("ausente"))
    return wanted.join(resolved, ["edition", "field"], "left").withColumn("status", status)
