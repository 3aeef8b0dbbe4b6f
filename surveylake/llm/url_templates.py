"""URL verdicts from fixed rules and, where none fits, from a tree of path templates.

Pages are first counted by host and shape of their path: numbers, hexadecimal names and digits inside
a segment are placeholders from the start. Level by level, a segment stays a literal branch only if
it has enough pages and its labelled block rate differs significantly from that of its siblings
together; where the host has too few pages or labels to tell, the same branch of the same template
over all hosts is judged instead. All other segments become the wildcard, which generalises variable
segments and merges similar branches. Labels are the pages that a rule decides. A template's block rate is smoothed
towards that of the same template over all hosts, and that one towards the rate of all labelled
pages; templates whose smoothed purity is too low are rejected.

Defined results: a NULL url, or one without ``://``, has an empty host and path and is one template
of its own. Without any labelled page every template is allowed. Repeated rows count as often as they occur. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, salted_join, saved

LEAST_PAGES = 5  # for a literal branch
SIGNIFICANT = 1.96
SMOOTHING = 2.0
REJECTED = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, pattern, 1), _UPPER, _LOWER), F.regexp_extract(whole, pattern, 2)


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (NULL if none does) and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), r.host, r.path)):  # the last one that fits wins
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def shape(path: Column) -> Column:
    """The path with variable names as placeholders, as one text."""
    names = F.transform(
        F.split(F.regexp_replace(path, "^/", ""), "/"),
        lambda s: F.when(s.rlike("^[0-9]+$"), F.lit("{n}"))
        .when(s.rlike("(?i)^(?=.*[0-9])[0-9a-f-]{8,}$"), F.lit("{h}"))
        .otherwise(F.regexp_replace(F.regexp_replace(s, r"[{}*]", "_"), "[0-9]+", "{n}")),
    )
    return F.array_join(names, "/")


def _rate(block: Column, labelled: Column, prior: Column) -> Column:
    return (block + F.lit(SMOOTHING) * prior) / (labelled + F.lit(SMOOTHING))


def _judged(branches: DataFrame, parent: list[str]) -> DataFrame:
    """The branches and whether their block rate ``differs`` from their siblings'; NULL with too few pages or labels."""
    parents = branches.groupBy(*parent).agg(F.sum("block").alias("all_block"), F.sum("labelled").alias("all_labelled"))
    judged = salted_join(branches, parents, parent, F.col("name"), salts=16)
    others = F.col("all_labelled") - F.col("labelled")
    pooled = F.col("all_block") / F.col("all_labelled")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / others))
    apart = F.abs(F.col("block") / F.col("labelled") - (F.col("all_block") - F.col("block")) / others)
    enough = (F.col("n") >= LEAST_PAGES) & (F.col("labelled") > 0) & (others > 0)
    return judged.withColumn("differs", F.when(enough, apart > F.lit(SIGNIFICANT) * spread))


def templates(shapes: DataFrame) -> DataFrame:
    """``host, shape, template`` of every row of ``shapes`` (``host, shape, n, block, labelled``)."""
    nodes = saved(shapes.select("*", F.split("shape", "/").alias("names"), F.lit("").alias("template")), "url-shapes")
    depth = nodes.groupBy().agg(F.max(F.size("names"))).first()[0] or 0
    for level in range(depth):
        deeper = F.size("names") > level
        left = nodes.where(deeper).groupBy().agg(F.sum("block").alias("block"), F.sum("labelled").alias("labelled")).first()
        if not 0 < left["block"] < left["labelled"]:  # no rates can differ from here on
            rest = F.concat("template", F.repeat(F.lit("/*"), F.size("names") - F.lit(level)))
            nodes = nodes.withColumn("template", F.when(deeper, rest).otherwise(F.col("template")))
            break
        step = nodes.withColumn("name", F.get("names", F.lit(level)))
        branches = step.where("name is not null").groupBy("host", "template", "name").agg(
            F.sum("n").alias("n"), F.sum("block").alias("block"), F.sum("labelled").alias("labelled")
        )
        branches = saved(branches, "url-branches")
        anywhere = branches.groupBy("template", "name").agg(*(F.sum(c).alias(c) for c in ("n", "block", "labelled")))
        anywhere = saved(_judged(anywhere, ["template"]).select("template", "name", F.col("differs").alias("elsewhere")), "url-pooled")
        here = _judged(branches, ["host", "template"])
        judged = salted_join(here, anywhere.where("elsewhere"), ["template", "name"], F.col("host"), salts=16, how="left")
        said = F.coalesce("differs", "elsewhere", F.lit(False))
        literal = judged.where(said).select("host", "template", "name", F.lit(True).alias("literal"))
        found = salted_join(step, literal, ["host", "template", "name"], F.col("shape"), salts=16, how="left")
        longer = F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("name")).otherwise(F.lit("*")))
        nodes = saved(
            found.withColumn("template", F.when(F.col("name").isNull(), F.col("template")).otherwise(longer)).drop("name", "literal"),
            "url-level",
        )
    return nodes.drop("names")


def purities(shapes: DataFrame) -> DataFrame:
    """``host, shape, template, block_rate`` with the smoothed block rate of each shape's template."""
    placed = saved(templates(shapes), "url-templates")
    totals = placed.groupBy().agg(F.sum("block").alias("block"), F.sum("labelled").alias("labelled")).first()
    prior = F.lit((totals["block"] or 0) / totals["labelled"] if totals["labelled"] else 0.0)
    here = placed.groupBy("host", "template").agg(F.sum("block").alias("block"), F.sum("labelled").alias("labelled"))
    there = here.groupBy("template").agg(_rate(F.sum("block"), F.sum("labelled"), prior).alias("template_rate"))
    rated = salted_join(here, there, ["template"], F.col("host"), salts=16).select(
        "host", "template", _rate(F.col("block"), F.col("labelled"), F.col("template_rate")).alias("block_rate")
    )
    return salted_join(placed.select("host", "shape", "template"), rated, ["host", "template"], F.col("shape"), salts=16)


def judge(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, block_rate`` of every page."""
    host, path = parts(column(url))
    read = pages.select(column(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    read = read.select("*", rule.alias("rule"), verdict.alias("ruled"), shape(F.col("path")).alias("shape"))
    shapes = read.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ruled") == "block").alias("block"), F.count("ruled").alias("labelled")
    )
    rated = purities(shapes)
    found = salted_join(read, rated, ["host", "shape"], F.struct("page_id", "path"), salts=16)
    said = F.when(F.col("block_rate") > REJECTED, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", said).alias("verdict"), "template", "block_rate")
