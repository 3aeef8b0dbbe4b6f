"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed greedily into the
longest pieces that occur in that labelled text; the language that needs the fewest phrases, each
weighted with the logarithm of its text length and divided by the characters read, wins.

A letter is one symbol. Where the samples have more letters than symbols, each language has symbols of
its own: its most frequent letters have one each, its others are spelled with three digits, and letters
that its sample lacks are unknown to it, so no two letters of a language are taken for one. Most letters
then stand in few contexts, and a letter unknown to a language costs two phrases, an escape and itself.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, and so is every text
if no labelled row can be learned from. Rows without a label or text are never learned from. Ties go
to the language that sorts first. Repeated rows and other columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.llm.common import column, fresh

UNKNOWN = "und"
# Texts are parsed in pieces of so many characters; a phrase does not cross a piece.
PIECE = 1024
# Letters with a symbol of their own in all, and beside digits if there are more letters.
SYMBOLS, FREQUENT = 250, 180
DIGITS = 64
CHUNK_CHARS = 2_000_000


@dataclass(frozen=True)
class Coding:
    """Symbols of letters: 0 no letter, 1 unknown letter."""

    classes: np.ndarray  # symbol of each code point
    spelled: np.ndarray  # number of each code point that is spelled with digits, else -1; empty if none is
    stride: int  # symbols and one that marks padding


@dataclass(frozen=True)
class Model:
    """``table[state + symbol]`` holds the next state (a place in the table) and the phrases closed on the way."""

    languages: tuple[str, ...]
    roots: np.ndarray
    weights: np.ndarray
    table: np.ndarray
    codings: tuple[Coding, ...]  # one for all languages or one for each


def _automaton(codes: np.ndarray) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton of a sequence (state 0 is the root)."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes.tolist():
        here = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and code not in edges[p]:
            edges[p][code] = here
            p = link[p]
        if p >= 0:
            q = edges[p][code]
            if length[p] + 1 == length[q]:
                link[here] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and edges[p].get(code) == q:
                    edges[p][code] = copy
                    p = link[p]
                link[q] = link[here] = copy
        last = here
    return edges, len(edges)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and each text's number of them."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), np.array([len(t) for t in texts], dtype=np.int64)


def _coding(letters: list[str], samples: list[str]) -> Coding:
    """Symbols for the sorted ``letters``, the most frequent of ``samples`` if they are too many."""
    rare: dict[str, int] = {}
    if len(letters) > SYMBOLS:
        counts: dict[str, int] = {}
        for text in samples:
            for c in text.lower():
                counts[c] = counts.get(c, 0) + 1
        ordered = sorted(letters, key=lambda c: (-counts[c], c))
        letters, rare = sorted(ordered[:FREQUENT]), {c: i for i, c in enumerate(ordered[FREQUENT:])}
    number = {c: i + 2 for i, c in enumerate(letters)}
    classes = np.zeros(0x110000, dtype=np.uint8)
    spelled = np.full(0x110000 if rare else 0, -1, dtype=np.int32)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            low = low if len(low) == 1 else low[0]
            classes[point] = number.get(low, 1)
            if low in rare:
                spelled[point] = rare[low]
    return Coding(classes, spelled, len(letters) + (DIGITS if rare else 0) + 3)


def _letters(texts: list[str], coding: Coding) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the characters with runs of non-letters as one, and what is left of each text."""
    points, sizes = _points(texts)
    codes = coding.classes[points]
    owner = np.repeat(np.arange(len(texts)), sizes)
    number = coding.spelled[points] if len(coding.spelled) else coding.spelled
    if (number >= 0).any():
        times = np.where(number >= 0, 3, 1)
        codes, owner = np.repeat(codes, times), np.repeat(owner, times)
        at = np.cumsum(times)[number >= 0] - 3
        for place, digit in enumerate(np.unravel_index(number[number >= 0], (DIGITS,) * 3)):
            codes[at + place] = 2 + FREQUENT + digit
    gap = codes == 0
    again = np.zeros(len(codes), dtype=bool)
    again[1:] = gap[1:] & gap[:-1] & (owner[1:] == owner[:-1])
    return codes[~again], np.bincount(owner[~again], minlength=len(texts))


def build(samples: dict[str, list[str]], chars: int) -> Model:
    """A model of labelled texts, of which each language uses ``chars`` symbols at most."""
    languages = tuple(sorted(lang for lang, texts in samples.items() if any(texts)))
    used = {lang: {c for text in samples[lang] for c in text.lower() if c.isalpha()} for lang in languages}
    every = sorted(set().union(*used.values()))
    if len(every) <= SYMBOLS:
        codings = (_coding(every, []),)
    else:
        codings = tuple(_coding(sorted(used[lang]), samples[lang]) for lang in languages)
    tables, roots, weights, base = [], [], [], 0
    for i, lang in enumerate(languages):
        coding = codings[i % len(codings)]
        codes, _ = _letters([" ".join(samples[lang])], coding)
        edges, states = _automaton(codes[:chars])
        table = np.full((states, coding.stride), -1, dtype=np.int64)
        for state, out in enumerate(edges):
            for code, to in out.items():
                table[state, code] = to
        root = table[0].copy()
        miss = table < 0
        unseen = miss & (root < 0)[None, :]
        # A miss closes the running phrase; a character that occurs nowhere is a phrase of its own, or two.
        alone = unseen * (1 if len(codings) == 1 else 2)
        cost = miss + alone
        cost[0] = alone[0]
        table = np.where(miss, np.where(root < 0, 0, root)[None, :], table)
        table[:, -1], cost[:, -1] = np.arange(states), 0
        tables.append(((table * coding.stride + base) << 2 | cost).ravel())
        roots.append(base)
        weights.append(np.log2(max(2, min(len(codes), chars))))
        base += table.size
    packed = np.concatenate(tables).astype(np.int64 if base >= 1 << 29 else np.int32) if tables else np.zeros(0, np.int32)
    return Model(languages, np.array(roots, dtype=packed.dtype), np.array(weights), packed, codings)


def phrases(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Phrases by text and language, and symbols read by text (of the first language)."""
    if len(model.codings) == 1:
        return _parsed(texts, model, model.codings[0], slice(None))
    found = [_parsed(texts, model, coding, slice(i, i + 1)) for i, coding in enumerate(model.codings)]
    return np.concatenate([total for total, _ in found], axis=1), found[0][1]


def _parsed(texts: list[str], model: Model, coding: Coding, some: slice) -> tuple[np.ndarray, np.ndarray]:
    codes, sizes = _letters(texts, coding)
    roots = model.roots[some]
    ends = np.cumsum(sizes)
    pieces_of = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(texts)), pieces_of)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of)
    start = (ends - sizes)[owner] + within * PIECE
    size = np.minimum(sizes[owner] - within * PIECE, PIECE)
    order = np.argsort(-size, kind="stable")
    start, size, owner = start[order], size[order], owner[order]
    state = np.repeat(roots[:, None], len(owner), axis=1)
    count = np.zeros(state.shape, dtype=np.int32)
    active = np.searchsorted(-size, -np.arange(1, PIECE + 1), side="right")
    for step in range(int(size.max(initial=0))):
        n = active[step]
        found = model.table[state[:, :n] + codes[start[:n] + step]]
        count[:, :n] += found & 3
        state[:, :n] = found >> 2
    count += state != roots[:, None]
    total = np.zeros((len(texts), len(roots)), dtype=np.int64)
    np.add.at(total, owner, count.T)
    return total, sizes


def classify(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is 0.5 for a tie of the two best and 1 at most."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    if not model.languages:
        return names, scores
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < CHUNK_CHARS):
            chars += len(texts[end] or "")
            end += 1
        part = [text or "" for text in texts[at:end]]
        total, sizes = phrases(part, model)
        entropy = total * model.weights / np.maximum(sizes, 1)[:, None]
        best = entropy.argmin(axis=1)
        low = np.sort(entropy, axis=1)
        second = low[:, 1] if low.shape[1] > 1 else np.full(len(part), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, second / np.maximum(low[:, 0] + second, 1e-12))
        has_letter = np.array([any(map(str.isalpha, text)) for text in part], dtype=bool)
        for i in np.flatnonzero(has_letter):
            names[at + i], scores[at + i] = model.languages[best[i]], score[i]
        at = end
    return names, scores


def fit(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = 64,
    snippet: int = 500,
    chars: int = 24_000,
) -> Model:
    """Learn from a bounded sample of the labelled rows that ``learn`` admits.

    The sample has ``rows`` rows for each language in the order of a hash of id and text, and of
    each row ``snippet`` characters at a hashed place; an automaton has ``chars`` characters at most.
    Labels may be wrong: each half of a language's sample is judged by a model of the other halves
    and rows that another language claims are left out.
    """
    key = F.xxhash64(column(doc_id), column(text))
    begin = F.pmod(key, F.greatest(F.length(column(text)) - F.lit(snippet), F.lit(0)) + 1) + 1
    labelled = docs.where(learn & column(lang).isNotNull() & column(text).rlike(r"\p{L}")).select(
        column(lang).alias("lang"), key.alias("key"), column(text).substr(begin.cast("int"), F.lit(snippet)).alias("text")
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key", "text"))
    sample = labelled.withColumn("place", place).where(F.col("place") <= rows).collect()
    halves: list[dict[str, list[str]]] = [{}, {}]
    for row in sorted(sample, key=lambda r: (r.lang, r.place)):
        halves[row.place % 2].setdefault(row.lang, []).append(row.text)
    kept: dict[str, list[str]] = {}
    for i, half in enumerate(halves):
        judge = build(halves[1 - i], chars)
        for language, texts in half.items():
            said, _ = classify(texts, judge)
            good = [t for t, name in zip(texts, said) if name == language or language not in judge.languages]
            kept.setdefault(language, []).extend(good or texts)
    return build(kept, chars)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows with two more columns, ``lang_pred`` and ``lang_score``.

    Columns of these names that the frame already has are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, scores = classify([t if isinstance(t, str) else None for t in batch], shared.value)
            yield pd.DataFrame({"lang_pred": names, "lang_score": scores})

    kept = [name for name in docs.columns if name.lower() not in ("lang_pred", "lang_score")]
    found = fresh(docs, "found")
    return docs.withColumn(found, judge(column(text))).select(*map(column, kept), f"{found}.lang_pred", f"{found}.lang_score")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from: the CRC-32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(column(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
