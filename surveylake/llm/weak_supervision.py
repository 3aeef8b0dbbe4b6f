"""Quality verdicts by weak supervision instead of filters that must all pass.

Simple rules on statistics of a text vote for good, for bad, or abstain. All documents are counted by
their pattern of votes; from these counts, whose number is bounded by the rules and not by the
documents, expectation-maximisation estimates how often each rule votes what on good and on bad
documents. A document's posterior probability of being good decides. The base checks decide some
documents by themselves; accuracies are meant to be estimated on all others, as the two classes would
otherwise be those that pass and fail these checks.

Defined results: a NULL text has no words. Statistics are those of whole texts; words are runs of
characters other than ASCII white space. Documents that fail the base checks are never kept. An empty
table gives no rows. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, fresh

WINDOW = 8
SYMBOLS = "#*$%&|<>"
KEPT = 0.5
ITERATIONS = 200

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " n_lines long, n_ended_lines long, n_letters long, n_upper long, n_exclaimed long, n_distinct long"
)
NAMES = [part.split()[0] for part in STATISTICS.split(",")]

_SPACES = " \t\n\v\f\r"
_UPPER = bytes(range(65, 91))
_OTHER_ASCII = bytes(b for b in range(128) if not chr(b).isalpha())


def repeated(ids: np.ndarray, window: int = WINDOW) -> int:
    """Places covered by windows that occur at least twice.

    Windows are numbered by doubling: equal pairs of equal halves get equal numbers, so nothing
    depends on a hash. ``window`` is a power of two.
    """
    n = len(ids)
    if n <= window:
        return 0
    width, number = 1, ids
    while width < window:
        pairs = number[:-width] * (int(number.max()) + 1) + number[width:]
        _, number = np.unique(pairs, return_inverse=True)
        width *= 2
    again = np.bincount(number)[number] > 1
    change = np.zeros(n + 1, dtype=np.int64)
    change[: len(again)] += again
    change[window : window + len(again)] -= again
    return int((np.cumsum(change[:-1]) > 0).sum())


def statistics(text: str) -> tuple[int, ...]:
    """The values of ``NAMES`` for one text."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], dtype=np.int64)
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    ended = sum(line.rstrip(_SPACES)[-1:] in ".!?:;\"'”»…)" for line in lines)
    letters = len(text) - (len(data) - len(data.translate(None, _OTHER_ASCII)))
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated(ids),
        len(lines),
        ended,
        letters,
        len(data) - len(data.translate(None, _UPPER)),
        text.count("!"),
        len(numbers),
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows with the statistics of their text (columns of these names are replaced)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([statistics(t if isinstance(t, str) else "") for t in batch], columns=NAMES).astype("int64")

    kept = [name for name in docs.columns if name.lower() not in NAMES]
    found = fresh(docs, "found")
    with_all = docs.withColumn(found, F.pandas_udf(run, STATISTICS)(column(text)))
    return with_all.select(*map(column, kept), *[f"{found}.{name}" for name in NAMES])


class Rule(NamedTuple):
    """Votes on a ratio: good up to ``good``, bad beyond ``bad``, else no vote; reversed if ``good`` is above ``bad``."""

    name: str
    ratio: Column
    good: float
    bad: float

    def vote(self) -> Column:
        r = self.ratio
        good, bad = (r <= self.good, r > self.bad) if self.good <= self.bad else (r >= self.good, r < self.bad)
        return F.when(good, 1).when(bad, -1).otherwise(0)


def default_rules() -> list[Rule]:
    """Rules that hold for prose in most alphabetic languages."""
    per = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return [
        Rule("length", F.col("n_words").cast("double"), 50, 20),
        Rule("word length", F.abs(F.try_divide(F.col("word_chars"), F.col("n_words")) - 6), 3.5, 6),
        Rule("symbols", per("n_symbols", "n_words"), 0.05, 0.1),
        Rule("repeated lines", per("n_dup_lines", "n_lines"), 0.1, 0.3),
        Rule("repeated words", per("n_repeat_words", "n_words"), 0.1, 0.25),
        Rule("ended lines", per("n_ended_lines", "n_lines"), 0.5, 0.15),
        Rule("letters", per("n_letters", "word_chars"), 0.8, 0.65),
        Rule("capitals", per("n_upper", "n_letters"), 0.2, 0.4),
        Rule("exclamations", per("n_exclaimed", "n_words"), 0.1, 0.3),
        Rule("variety", F.try_divide(F.col("n_distinct"), F.sqrt("n_words")), 3, 1.5),
    ]


class Accuracies(NamedTuple):
    prior: float  # probability of a good document
    good: np.ndarray  # by rule and vote (-1, 0, 1): probability on good documents
    bad: np.ndarray


def estimate(patterns: np.ndarray, counts: np.ndarray) -> Accuracies:
    """Expectation-maximisation over counted vote patterns (rows of -1, 0, 1).

    It starts from the share of good votes, which also fixes which class is the good one; each
    probability is smoothed by one document of each vote.
    """
    votes = np.stack([(patterns == v) for v in (-1, 0, 1)], axis=2).astype(float)
    good = (1 + (patterns == 1).sum(axis=1)) / (2 + (patterns != 0).sum(axis=1))
    total = counts.sum()
    for _ in range(ITERATIONS):
        tables = []
        for share in (good, 1 - good):
            mass = np.einsum("p,prv->rv", counts * share, votes) + 1
            tables.append(mass / mass.sum(axis=1, keepdims=True))
        prior = min(max((counts * good).sum() / total, 1e-6), 1 - 1e-6)
        odds = math.log(prior / (1 - prior)) + np.einsum("prv,rv->p", votes, np.log(tables[0]) - np.log(tables[1]))
        former, good = good, 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(former - good).max() < 1e-9:
            break
    return Accuracies(prior, *tables)


def fit(frame: DataFrame, rules: Sequence[Rule]) -> Accuracies:
    """Accuracies from the vote patterns of all rows (at most 3 to the number of rules patterns)."""
    if len(rules) > 12:
        raise ValueError("the number of vote patterns is bounded for 12 rules at most")
    votes = F.array(*[rule.vote() for rule in rules])
    counted = frame.groupBy(votes.alias("votes")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counted:
        even = np.full((len(rules), 3), 1 / 3)
        return Accuracies(0.5, even, even)
    counted.sort(key=lambda row: row["votes"])
    return estimate(np.array([row["votes"] for row in counted]), np.array([row["n"] for row in counted], dtype=float))


def posterior(rules: Sequence[Rule], known: Accuracies) -> Column:
    """Probability of being good, from the votes of a row."""
    odds = F.lit(math.log(known.prior / (1 - known.prior)))
    for rule, good, bad in zip(rules, known.good, known.bad):
        vote = rule.vote()
        low, none, high = (float(x) for x in np.log(good) - np.log(bad))
        odds = odds + F.when(vote == 1, high).when(vote == -1, low).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def base_failed() -> Column:
    """Too short, or too much of the text in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
