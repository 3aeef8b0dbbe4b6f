"""Exports with line breaks inside quoted answers, read by many tasks a file.

Spark splits a text file into byte ranges at line ends, but a line end may lie inside a quoted answer.
Each line is a function of two states (outside or inside quotes at its start) to the state at its
end, told by two patterns. Such functions compose: within a range by windows, over the few ranges of
a file by a second window. Then every line knows its state at its start, so records are cut, those of
several lines are joined, and each is parsed by Spark's own ``from_csv``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LONGEST_RECORD = 1 << 26
PATH = "_path"

# Possessive patterns: one pass over the line, without recursion. A quote opens at the start of a field only.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,'
_LEFT_OPEN = rf'(?:{_FIELD})*+"{_INSIDE}\z'
OPENS = rf"\A{_LEFT_OPEN}"
STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,{_LEFT_OPEN})'


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every line with its file, the start of its byte range, its order there and its effect on the state."""
    text = spark.read.option("lineSep", "\n").text(paths)
    quoted = F.contains("value", F.lit('"'))
    opens, stays = quoted & F.col("value").rlike(OPENS), ~quoted | F.col("value").rlike(STAYS)
    return text.select(
        "value",
        F.col("_metadata.file_path").alias(PATH),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
        # A line either sets the state, whatever it was, or keeps or turns it.
        F.when(opens == stays, opens).alias("_sets"),
        (opens & ~stays).cast("long").alias("_turns"),
        F.endswith("value", F.lit("\r")).alias("_cr"),
    )


def _composed(df: DataFrame, window: Window) -> DataFrame:
    """``_after``: the state behind each row where any row up to it sets it; ``_flips``: turns since that row, or all."""
    turned = df.withColumn("_turned", F.sum("_turns").over(window))
    last = F.last(F.when(F.col("_sets").isNotNull(), F.struct("_sets", "_turned")), ignorenulls=True).over(window)
    known = turned.withColumn("_last", last)
    flips = F.col("_turned") - F.coalesce("_last._turned", F.lit(0))
    return known.withColumn("_flips", flips % 2).withColumn("_after", F.col("_last._sets")).drop("_turned", "_last")


def _state(before: Column) -> Column:
    """Inside quotes behind a row, from the state before the first row of its window."""
    return F.coalesce("_after", before) != (F.col("_flips") == 1)


def _carried(lines: DataFrame) -> DataFrame:
    """Per byte range: whether its first line starts inside quotes, and whether the file's first line ends in CR and LF."""
    ends = _composed(lines, Window.partitionBy(PATH, "_start").orderBy("_line"))
    last = F.struct(F.col("_after").alias("_sets"), F.col("_flips").alias("_turns"))
    ranges = ends.groupBy(PATH, "_start").agg(F.max_by(last, "_line").alias("_whole"), F.min_by("_cr", "_line").alias("_cr"))
    # A range that sets the state has turned it since; folded into what it sets.
    whole = ranges.select(
        PATH, "_start",
        (F.col("_whole._sets") != (F.col("_whole._turns") == 1)).alias("_sets"),
        F.when(F.col("_whole._sets").isNull(), F.col("_whole._turns")).otherwise(0).alias("_turns"),
        "_cr",
    )
    in_file = Window.partitionBy(PATH).orderBy("_start")
    behind = _composed(whole, in_file).withColumn("_end", _state(F.lit(False)))
    return behind.select(PATH, "_start", F.lag("_end", 1, False).over(in_file).alias("_inside"), F.first("_cr").over(in_file).alias("_crlf"))


def records(spark: SparkSession, paths: list[str], longest: int = LONGEST_RECORD) -> DataFrame:
    """(path, number, text) of every record of every file, numbered from 1 where the header is; no empty ones.

    A record of more than ``longest`` characters in one range is an error that names the file: as a
    rule a quote that is never closed.
    """
    lines = _lines(spark, paths)
    carried = _carried(lines)
    in_range = Window.partitionBy(PATH, "_start").orderBy("_line")
    placed = _composed(lines, in_range).drop("_cr").join(carried, [PATH, "_start"], "left")
    # Where a line starts does not depend on how files are cut, so a range known here has the right state.
    inside = F.coalesce("_inside", F.raise_error(F.lit("files were cut at other places when read again")).cast("boolean"))
    placed = placed.withColumn("_inside", inside).withColumn("_open", _state(F.col("_inside")))
    placed = placed.withColumn("_opened", F.coalesce(F.lag("_open").over(in_range), "_inside"))
    placed = placed.where(F.col("_opened") | ~((F.col("value") == "") | F.col("_crlf") & (F.col("value") == "\r")))
    begins = (~F.col("_opened")).cast("long")
    size = F.sum(F.length("value") + 1).over(in_range)
    placed = placed.withColumns({"_nth": F.sum(begins).over(in_range), "_size": size})
    placed = placed.withColumn("_long", F.col("_size") - F.coalesce(F.max(F.when(begins == 1, F.col("_size") - F.length("value"))).over(in_range), F.lit(0)))
    too_long = F.concat(F.lit("unclosed quote? a record is too long in "), F.col(PATH))
    placed = placed.where(F.when(F.col("_long") > longest, F.raise_error(too_long).cast("boolean")).otherwise(True))

    counts = placed.groupBy(PATH, "_start").agg(F.max("_nth").alias("_records"))
    earlier = Window.partitionBy(PATH).orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(PATH, "_start", F.coalesce(F.sum("_records").over(earlier), F.lit(0)).alias("_shift"))
    numbered = placed.join(shifts, [PATH, "_start"]).withColumn("_record", F.col("_nth") + F.col("_shift"))
    # Where the file's first line ends in CR and LF, these are one line end everywhere, as for Spark's reader.
    ended = F.when(F.col("_crlf"), F.replace(F.regexp_replace("text", r"\r\z", ""), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("text"))
    alone = numbered.where(~F.col("_opened") & ~F.col("_open")).select(PATH, "_record", "_crlf", F.col("value").alias("text"))
    several = numbered.where(F.col("_opened") | F.col("_open")).groupBy(PATH, "_record", "_crlf").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("_start", "_line", "value"))).getField("value"), "\n").alias("text")
    )
    return alone.union(several).select(PATH, "_record", ended.alias("text"))


def read_split_csv(spark: SparkSession, paths: list[str], columns: int, longest: int = LONGEST_RECORD) -> DataFrame:
    """``c0``, ``c1`` … as strings and the path of the file (``_path``), the header record of each file skipped.

    The rows are those of Spark's ``multiLine`` reader, without its limit of one task for each file.
    """
    schema = ", ".join(f"c{i} string" for i in range(columns))
    answers = F.from_csv("text", schema, {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"})
    return records(spark, paths, longest).where(F.col("_record") > 1).select(answers.alias("_answers"), PATH).select("_answers.*", PATH)
