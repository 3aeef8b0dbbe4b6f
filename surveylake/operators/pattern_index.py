"""Regular expressions kept as data, tested only on the names that can match them.

A name's words are its runs of letters and digits. A pattern that spells out a whole word, set off by
underscores or the ends of the name, matches only names that have this word. So each pattern is joined
to names by its rarest such word, and the expression itself is evaluated on these candidates alone.
Patterns without such a word are few; they are tested on every distinct name as literals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNINDEXED_MOST = 500  # patterns without a whole word that one call accepts
_ANY = "\u0001"  # stands for whatever a pattern leaves open
_DEPTH = 4  # groups within groups that are read


def required_words(pattern: Column) -> Column:
    """Words that every match of a pattern has whole; empty where none is certain.

    Only what stands outside of groups, classes and repeats counts. Patterns with inline flags,
    alternatives outside of groups or rarer escapes are not read.
    """
    body = F.regexp_replace(pattern, r"\\.", _ANY)
    body = F.regexp_replace(body, r"\[[^\]]*\]", _ANY)
    body = F.regexp_replace(F.regexp_replace(body, r"^\^", "_"), r"\$$", "_")
    body = F.regexp_replace(body, r"[^()|](?:[?*+]|\{[^}]*\})[?+]?", _ANY)
    for _ in range(_DEPTH):
        body = F.regexp_replace(body, r"\([^()]*\)(?:[?*+]|\{[^}]*\})?[?+]?", _ANY)
    unread = pattern.rlike(r"\(\?|\\[^dDwWsSbB._^$|()\[\]{}+*?-]") | body.rlike(r"[()|]")
    words = F.regexp_extract_all(body, F.lit(r"(?<=_)([a-z0-9]+)(?=_)"), F.lit(1))
    return F.when(unread, F.array().cast("array<string>")).otherwise(F.array_distinct(words))


def match_patterns(names: DataFrame, patterns: DataFrame, name: str = "name", pattern: str = "pattern") -> DataFrame:
    """Each row of ``names`` with each row of ``patterns`` whose expression is found in its name.

    The result equals testing every pattern on every name. A NULL name or pattern matches nothing;
    names in lower case are assumed to be words of letters and digits. Both tables must not share a
    column. More than ``UNINDEXED_MOST`` patterns without a whole word are an error.
    """
    shared = {c.lower() for c in names.columns} & {c.lower() for c in patterns.columns}
    if shared:
        raise ValueError(f"columns of both tables: {sorted(shared)}")
    distinct = names.select(name).where(F.col(name).isNotNull()).distinct()
    words = distinct.select(name, F.explode(F.array_distinct(F.split(name, "[^a-z0-9]+"))).alias("_word")).where("_word != ''")
    rules = patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct().withColumn("_words", required_words(F.col(pattern)))
    # A word that no name has is the rarest one and leaves its pattern without candidates.
    frequency = words.groupBy("_word").agg(F.count(F.lit(1)).alias("_n"))
    counted = rules.select(pattern, F.explode("_words").alias("_word")).join(frequency, "_word", "left")
    rarest = counted.groupBy(pattern).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_word"))["_word"].alias("_word"))
    found = words.join(rarest, "_word").where(F.regexp_like(F.col(name), F.col(pattern))).select(name, pattern)
    rest = [row[0] for row in rules.where(F.size("_words") == 0).select(pattern).limit(UNINDEXED_MOST + 1).collect()]
    if len(rest) > UNINDEXED_MOST:
        raise ValueError(f"more than {UNINDEXED_MOST} patterns have no whole word")
    if rest:
        hits = F.array_compact(F.array(*[F.when(F.col(name).rlike(p), F.lit(p)) for p in sorted(rest)]))
        found = found.unionByName(distinct.select(name, F.explode(hits).alias(pattern)))
    return names.join(found, name).join(patterns, pattern).select(*names.columns, *patterns.columns)
