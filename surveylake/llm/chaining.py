"""Passages that repeat across documents, found by collinear chaining of shared k-mers.

Every document keeps the smallest hash in each run of ``PICK`` neighbouring k-mers of ``K`` words, so
two documents that share ``K + PICK - 1`` words in a row share a seed. Each seed that more than one
document has is joined to its first occurrence, the anchor; a seed of any frequency makes as many
links as it has occurrences and no pairs among them. The links of a document with an anchor document
are chained in the order of both texts: a Fenwick tree over the anchor's places gives the best chain
to extend, less a cost for the gap. The chains are aligned on the words themselves: exact runs around
the seeds are extended, short gaps are bridged by their longest common subsequence, and what reaches
``LEAST`` equal words at ``IDENTITY`` is a passage.

The first occurrences of a passage's seeds may lie in documents that hold fragments of it only. So
where shared seeds could hold ``LEAST`` equal words in a row that no passage covers, the hashes of
all windows of ``LEAST`` words are joined to the first occurrence of the window, which is a passage.

Defined results: texts that are NULL or shorter than a k-mer have no passages. Rows that repeat both
id and text are one document; repeats within one document are no passages. Passages are places of words (runs
without ASCII white space), end exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, row_key, salted_join, saved, text_of
from surveylake.llm.words import mix, shingles, word_hashes
from surveylake.session import settings

K, PICK = 6, 12
LEAST = 50
IDENTITY = 0.8
GAP = 10  # words that an alignment bridges on either side
AHEAD = GAP + 3  # words that are looked at behind an exact run
MARGIN = 48  # words on either side of the chains of a pair that are sent to be aligned
REACH = K + PICK + GAP  # words between neighbouring shared seeds of a passage, at most
SPAN = 10  # words from the first to the last shared seed of a passage, at least
GAP_COST = 0.015  # of a seed's worth, for each word of distance on either side
CHUNK_CHARS = 2_000_000
STRETCH = -1  # the anchor's number in rows that hold a document's stretches
LISTED = 1 << 18  # words of a text, at most, whose numbers are kept in a list
GROUP = 64  # documents aligned with one anchor document in one group
PASSAGE = ["doc_id", "partner_id", "start", "end", "partner_start", "partner_end", "n_equal", "uid", "anchor"]


def _leftmost_least(kmers: np.ndarray) -> np.ndarray:
    """Place of the leftmost least value in each run of ``PICK``, from runs of half the width."""
    value, place, width = kmers, np.arange(len(kmers)), 1
    while width < PICK:
        step = min(width, PICK - width)
        right = value[step:] < value[:-step]
        value, place, width = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step]), width + step
    return place


def all_seeds(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of the picked k-mers of all texts in order, and where those of each text begin.

    ``first`` holds the first word of each text, and the end.
    """
    counts = np.maximum(np.diff(first) - K + 1, 0)
    kmers = mix(shingles(hashes, K))
    picked = []
    if len(kmers) >= PICK:
        windows = np.maximum(counts - PICK + 1, 0)
        # The windows inside a text, and the leftmost least k-mer of each; that never moves back.
        inside = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows) + np.arange(windows.sum())
        least = _leftmost_least(kmers)[inside]
        picked.append(least[np.flatnonzero(np.diff(least, prepend=-1))])
    short = np.flatnonzero((counts > 0) & (counts < PICK))
    picked.append(np.array([first[i] + kmers[first[i] : first[i] + counts[i]].argmin() for i in short], dtype=np.int64))
    places = np.sort(np.concatenate(picked))
    text = np.searchsorted(first, places, side="right") - 1
    return kmers[places], places - first[text], np.searchsorted(text, np.arange(len(first)))


def seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the picked k-mers of a text."""
    return all_seeds(hashes, np.array([0, len(hashes)]))[:2]


def _chunks(texts: list[str], hashed: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The number of the first text and the ``word_hashes``, for some texts at a time."""
    at = 0
    while at < len(texts):
        begin, chars = at, 0
        while at < len(texts) and (at == begin or chars < CHUNK_CHARS):
            chars += len(texts[at])
            at += 1
        yield begin, *word_hashes(texts[begin:at], hashed)


def first_ones(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the values (64 bits) of some texts (``of``) have no equal before them in their text."""
    tagged = mix(values.view(np.uint64) ^ mix(of.astype(np.uint64)))
    ascending = np.sort(tagged)
    first = np.ones(len(values), dtype=bool)
    if len(twice := ascending[1:][ascending[1:] == ascending[:-1]]):
        some = np.flatnonzero(np.isin(tagged, twice))
        some = some[np.lexsort((some, values[some], of[some]))]
        first[some[1:]] = (values[some[1:]] != values[some[:-1]]) | (of[some[1:]] != of[some[:-1]])
    return first


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """The values as one list from each start to the next; the last start is the end."""
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values).cast(kind))


def _seed_rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Seeds and places of each text. Those with no equal before them come first; ``firsts`` is their number."""
    for batch in batches:
        found = []
        for _, hashes, first, _, _ in _chunks(batch.to_pylist()):
            values, places, starts = all_seeds(hashes, first)
            of = np.repeat(np.arange(len(first) - 1), np.diff(starts))
            new = first_ones(values, of)
            if not new.all():
                order = np.argsort(2 * of + ~new, kind="stable")
                values, places = values[order], places[order]
            firsts = np.bincount(of[new], minlength=len(first) - 1)
            lists = (_lists(values.view(np.int64), starts, pa.int64()), _lists(places, starts, pa.int32()), pa.array(firsts, pa.int32()))
            found.append(pa.StructArray.from_arrays(lists, ["seeds", "places", "firsts"]))
        if found:
            yield pa.concat_arrays(found)


def chains(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Links (places ``a`` in the anchor, ``b`` in the document) split into chains that ascend in both.

    A link is worth 1; following another one costs ``GAP_COST`` for every word between them in
    either text. Links at one place of the document are entered together, so they never follow one
    another. Chains are taken best first.
    """
    if len(a) == 1:
        return [np.zeros(1, dtype=np.int64)]
    order = np.lexsort((a, b))
    a, b = a[order], b[order]
    ascending = bool((np.diff(a) > 0).all() and (np.diff(b) > 0).all())
    score, before = (_scores_in_order if ascending else _scores)(a.tolist(), b.tolist())
    if ascending and before[1:] == list(range(len(a) - 1)) and score[-1] == max(score) > max(score[:-1]):
        return [order]
    used, out = [False] * len(a), []
    for end in sorted(range(len(a)), key=lambda link: (-score[link], link)):
        chain, link = [], end
        while link >= 0 and not used[link]:
            used[link] = True
            chain.append(link)
            link = before[link]
        if chain:
            out.append(order[np.array(chain[::-1])])
    return out


def _scores_in_order(a: list[int], b: list[int]) -> tuple[list[float], list[int]]:
    """Best values of chains and the link before, where every link may follow all before it.

    Then the link just before is the best one to follow: it is worth more, as the values are taken
    less the distance from the origin.
    """
    score, before, best = [], [], -np.inf
    for link, (one, other) in enumerate(zip(a, b)):
        far = GAP_COST * (one + other)
        gained = best - far
        follows = gained > 0
        score.append(1.0 + gained if follows else 1.0)
        before.append(link - 1 if follows else -1)
        best = score[-1] + far
    return score, before


def _scores(a: list[int], b: list[int]) -> tuple[list[float], list[int]]:
    """Best value of a chain up to each link, and the link before it; the links ascend in ``b``."""
    ranks = {place: i + 1 for i, place in enumerate(sorted(set(a)))}
    size = len(ranks)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)  # best value and its link among smaller places
    score, before = [1.0] * len(a), [-1] * len(a)
    i = 0
    while i < len(a):
        j = i
        while j < len(a) and b[j] == b[i]:
            best, at = (-np.inf, -1), ranks[a[j]] - 1
            while at > 0:
                if tree[at] > best:
                    best = tree[at]
                at -= at & -at
            # Values in the tree hold the distance from the origin, so the gap cost is a difference.
            gained = best[0] - GAP_COST * (a[j] + b[j])
            if best[1] >= 0 and gained > 0:
                score[j], before[j] = 1.0 + gained, best[1]
            j += 1
        for link in range(i, j):
            value, at = (score[link] + GAP_COST * (a[link] + b[link]), link), ranks[a[link]]
            while at <= size:
                if value > tree[at]:
                    tree[at] = value
                at += at & -at
        i = j
    return score, before


def _common(x: list[int], y: list[int]) -> int:
    """Length of the longest common subsequence of two short lists."""
    if not x or not y:
        return 0
    row = [0] * (len(y) + 1)
    for one in x:
        former = 0
        for j, other in enumerate(y, 1):
            kept = row[j]
            row[j] = former + 1 if one == other else max(row[j], row[j - 1])
            former = kept
    return row[-1]


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """Equal entries from the start on."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        differ = x[at : min(n, at + step)] != y[at : min(n, at + step)]
        one = int(differ.argmax())
        if differ[one]:
            return at + one
        at, step = at + step, step * 4
    return n


def threes(words: np.ndarray) -> np.ndarray:
    """One number for each three words in a row."""
    return shingles(words, 3) if len(words) >= 3 else words[:0]


def _listed(values: np.ndarray) -> Sequence[int]:
    """The values as a list, which is read faster; those of a very long text stay an array, which is smaller."""
    return values.tolist() if len(values) <= LISTED else values


def _resume(x: Sequence[int], y: Sequence[int]) -> tuple[int, int] | None:
    """The nearest places of an equal number in two short lists."""
    if set(x).isdisjoint(y):
        return None
    where = {}  # the first place in y
    for j in range(len(y) - 1, -1, -1):
        where[y[j]] = j
    best = None
    for i, three in enumerate(x):
        j = where.get(three)
        if j is not None and (best is None or i + j < sum(best)):
            best = (i, j)
    return best


def exact_runs(
    x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]], x3: Sequence[int] | None = None, y3: Sequence[int] | None = None
) -> list[tuple[int, int, int]]:
    """Exact runs round a chain of seeds in ascending order: start in ``x`` and in ``y``, and length.

    Two runs are at most ``GAP`` words apart on either side, and the latter has three words at least.
    Words beyond ``AHEAD`` of the first and the last run are not looked at. ``x3`` and ``y3`` are the
    ``threes`` of the words.
    """
    x3, y3 = threes(x) if x3 is None else x3, threes(y) if y3 is None else y3
    blocks: list[tuple[int, int, int]] = []
    after_i = after_j = 0  # the words behind what is aligned

    for i, j in chain:
        if i < after_i or j < after_j:
            continue  # inside what is aligned
        length = _run(x[i:], y[j:])
        if length < K and length < min(K, len(x) - i, len(y) - j):
            continue  # equal hashes of different words
        n = _run(x[after_i:i][::-1], y[after_j:j][::-1])
        i, j, length = i - n, j - n, length + n
        if not blocks:  # what stands before the first seed is found from there backwards
            u, v = i, j
            while ahead := _resume(x3[max(0, u - AHEAD) : max(0, u - 2)][::-1], y3[max(0, v - AHEAD) : max(0, v - 2)][::-1]):
                u, v = u - ahead[0], v - ahead[1]
                more = _run(x[:u][::-1], y[:v][::-1])
                u, v = u - more, v - more
                blocks.append((u, v, more))
            blocks.reverse()
        while True:  # exact runs from here on until the texts part
            blocks.append((i, j, length))
            after_i, after_j = i + length, j + length
            ahead = _resume(x3[after_i : after_i + GAP + 1], y3[after_j : after_j + GAP + 1])
            if ahead is None:
                break
            i, j = after_i + ahead[0], after_j + ahead[1]
            length = _run(x[i:], y[j:])
    return blocks


def align(x: np.ndarray, y: np.ndarray, chain: list[tuple[int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages round a chain of seeds: start and end in ``x`` and in ``y``, and the equal words."""
    return joined_runs(x, y, exact_runs(x, y, chain))


def joined_runs(x: np.ndarray, y: np.ndarray, blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Passages of exact runs and the short gaps between them."""
    passages, at = [], 0
    while at < len(blocks):
        i, j, equal = blocks[at]
        end_i, end_j = i + equal, j + equal
        begin = at
        at += 1
        while at < len(blocks) and blocks[at][0] - end_i <= GAP and blocks[at][1] - end_j <= GAP:
            u, v, length = blocks[at]
            equal += length + _common(x[end_i:u].tolist(), y[end_j:v].tolist())
            end_i, end_j = u + length, v + length
            at += 1
        if equal >= LEAST and equal >= IDENTITY * max(end_i - i, end_j - j):
            passages.append((i, end_i, j, end_j, equal))
        else:  # poor neighbours do not take an exact run along
            passages += [(u, u + n, v, v + n, n) for u, v, n in blocks[begin:at] if n >= LEAST]
    return passages


def all_chains(anchor: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Chains of all links of one document with each of its anchor documents."""
    if not len(anchor):
        return []
    order = np.argsort(anchor, kind="stable")
    others, starts = np.unique(anchor[order], return_index=True)
    found = []
    for other, low, high in zip(others, starts, [*starts[1:], len(order)]):
        own = order[low:high]
        found += [(int(other), own[chain]) for chain in chains(a[own], b[own])]
    return found


def document_chains(anchor: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Chains of all links of one document (``anchor`` is the other document) that may be in a passage.

    Every passage leaves shared seeds all along it, whatever their anchors. So links count only
    where the document's shared seeds span ``SPAN`` words without a gap above ``REACH``. A chain of
    one seed is left out where a longer chain of the document reaches over it: its stretch is
    aligned already.
    """
    places = np.unique(b)
    cuts = np.flatnonzero(np.diff(places) > REACH) + 1
    good = [run for run in np.split(places, cuts) if run[-1] - run[0] >= SPAN]
    if not good:
        return []
    kept = np.flatnonzero(np.isin(b, np.concatenate(good)))
    found = [(other, kept[links]) for other, links in all_chains(anchor[kept], a[kept], b[kept])]
    long = [(b[links[0]] - K - PICK, b[links[-1]] + K + PICK) for _, links in found if len(links) > 1]
    return [
        (other, links)
        for other, links in found
        if len(links) > 1 or not any(low <= b[links[0]] <= high for low, high in long)
    ]


def all_stretches(places: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the stretches that hold every run of ``LEAST`` words with an equal elsewhere, and their texts.

    ``places`` are those of the shared seeds of some texts (``of``). All seeds picked from windows
    inside of such a run are shared: neighbours are ``PICK`` words apart at most, and the first and
    the last one less than ``PICK`` k-mers from the run's ends.
    """
    order = np.lexsort((places, of))
    places, of = places[order], of[order]
    cut = np.flatnonzero((np.diff(of) != 0) | (np.diff(places) > PICK))
    first, last = np.append(0, cut + 1)[: len(places)], np.append(cut, len(places) - 1)[: len(places)]
    long = places[last] - places[first] >= LEAST - K - 2 * (PICK - 1)
    first, last = first[long], last[long]
    return np.maximum(places[first] - PICK + 1, 0).astype(np.int32), (places[last] + K + PICK - 1).astype(np.int32), of[first]


def stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``all_stretches`` of one text."""
    return all_stretches(places, np.zeros_like(places))[:2]


def windows_in(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of the first ``n`` windows of ``LEAST`` words lie in one of the ranges of words."""
    starts, stops = np.minimum(starts, n), np.minimum(np.maximum(ends - LEAST + 1, starts), n)
    change = np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def _chain_rows(frame: pd.DataFrame) -> pd.DataFrame:
    """Each chain that may be in a passage, and the stretches of each document."""
    uid, anchor = frame["uid"].to_numpy(), frame["anchor"].to_numpy()
    a, b = frame["anchor_place"].to_numpy(), frame["place"].to_numpy()
    cuts = [0, *(np.flatnonzero(uid[1:] != uid[:-1]) + 1).tolist(), len(frame)]
    rows = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        links_of = low + np.flatnonzero(anchor[low:high] != uid[low])
        for other, links in document_chains(anchor[links_of], a[links_of], b[links_of]):
            rows.append((other, uid[low], a[links_of[links]], b[links_of[links]]))
        starts, ends = stretches(b[low:high])
        if len(starts):
            rows.append((STRETCH, uid[low], starts, ends))
    return pd.DataFrame(rows, columns=["anchor", "uid", "anchor_places", "places"])


def _pair_rows(frame: pd.DataFrame) -> pa.RecordBatch:
    """All chains of each document with each of its anchor documents, one after another, and its stretches."""
    uid, anchor = frame["uid"].to_numpy(), frame["anchor"].to_numpy()
    a, b = frame["anchor_place"].to_numpy(), frame["place"].to_numpy()
    starts, ends, of = all_stretches(b, uid)
    links = np.flatnonzero(anchor != uid)
    links = links[np.lexsort((a[links], b[links], anchor[links], uid[links]))]
    anchor, uid, a, b = anchor[links], uid[links], a[links], b[links]
    heads = np.flatnonzero((np.diff(anchor, prepend=-1) != 0) | (np.diff(uid, prepend=-1) != 0))
    bounds = np.append(heads, len(links))
    order, sizes, counts = np.arange(len(links)), [], np.ones(len(heads), dtype=np.int64)
    for pair, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if high - low == 1:
            sizes.append(1)
            continue
        found = chains(a[low:high], b[low:high])
        order[low:high] = low + np.concatenate(found)
        sizes += map(len, found)
        counts[pair] = len(found)
    own = np.flatnonzero(np.diff(of, prepend=-1))
    more = np.append(own, len(of))[1:] + len(links)
    columns = {
        "anchor": np.append(anchor[heads], np.full(len(own), STRETCH)),
        "uid": np.append(uid[heads], of[own]),
        "anchor_places": _lists(np.append(a[order], starts), np.append(bounds, more), pa.int32()),
        "places": _lists(np.append(b[order], ends), np.append(bounds, more), pa.int32()),
        "sizes": _lists(np.array(sizes, dtype=np.int64), np.append(0, np.cumsum(np.append(counts, np.zeros(len(own), dtype=np.int64)))), pa.int32()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _chained(batches: Iterator[pd.DataFrame], made: Callable = _chain_rows) -> Iterator:
    """What is made of the rows of some documents at a time; the rows of a document follow one another."""
    waiting: list[pd.DataFrame] = []
    for frame in batches:
        if not len(frame):
            continue
        last = (frame["uid"] == frame["uid"].iloc[-1]).to_numpy()
        if last.all() and (not waiting or waiting[0]["uid"].iloc[0] == frame["uid"].iloc[0]):
            waiting.append(frame)
            continue
        yield made(pd.concat([*waiting, frame[~last]]))
        waiting = [frame[last]]
    if waiting:
        yield made(pd.concat(waiting))


class _Stretch(NamedTuple):
    """Words of a text from ``begin`` on; ``before`` and ``behind`` tell whether the text has others."""

    words: np.ndarray
    threes: Sequence[int]
    begin: int
    before: bool
    behind: bool

    def holds(self, start: int, end: int) -> bool:
        """Whether all that is looked at round these words is here."""
        return (not self.before or start >= AHEAD) and (not self.behind or end + AHEAD <= len(self.words))


def _cut_out(margin: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The wanted words of each text and ``margin`` words on either side, or the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at, _, first, starts, ends in _chunks(texts, hashed=False):
                some = batch.slice(at, len(first) - 1)
                wanted, of = some.column("wanted").flatten(), pc.list_parent_indices(some.column("wanted")).to_numpy()
                n = np.diff(first)[of]
                if margin is None:
                    low, high = np.zeros_like(n), n
                else:
                    low = np.maximum(pc.struct_field(wanted, "low").to_numpy() - margin, 0)
                    high = np.minimum(pc.struct_field(wanted, "high").to_numpy() + K + margin, n)
                data = [text.encode("utf-8", "replace") for text in texts[at : at + len(first) - 1]]
                a, b = starts[first[of] + low], ends[first[of] + high - 1]
                parts = [data[i][begin:end] for i, begin, end in zip(of.tolist(), a.tolist(), b.tolist())]
                columns = {name: pc.struct_field(wanted, name) for name in ("anchor", "part", "anchor_places", "places", "sizes")}
                columns |= {name: some.column(name).take(pa.array(of)) for name in ("doc_id", "uid")}
                columns |= {"text": pa.array(parts, pa.binary()).cast(pa.string()), "begin": pa.array(low, pa.int32()), "behind": pa.array(high < n)}
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of documents with their anchor document, which stands before them.

    A pair whose runs may go on beyond the words that were sent has one row without places instead.
    """
    leader, x = None, None
    for batch in batches:
        ids, uids = batch.column("doc_id").to_pylist(), batch.column("uid").to_pylist()
        sizes, begins, behind = (batch.column(name).to_pylist() for name in ("sizes", "begin", "behind"))
        # The lists of a batch stand in one array; a leader's list is empty there.
        places = [(batch.column(name).values.to_numpy(), batch.column(name).offsets.to_pylist()) for name in ("anchor_places", "places")]
        for at, hashes, first, _, _ in _chunks(batch.column("text").to_pylist()):
            rows = []
            all_threes = threes(hashes)
            for i, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist()), at):
                y = _Stretch(hashes[low:high], _listed(all_threes[low : max(low, high - 2)]), begins[i], begins[i] > 0, behind[i])
                if sizes[i] is None:
                    leader, x = (ids[i], uids[i]), y._replace(words=y.words.copy())
                    continue
                found = _passages_of(x, y, *(values[starts[i] : starts[i + 1]] for values, starts in places), sizes[i])
                pair = (uids[i], leader[1])
                if found is None:
                    rows.append((ids[i], leader[0], None, None, None, None, None, *pair))
                else:
                    rows += [(ids[i], leader[0], j, end_j, a, end_a, equal, *pair) for a, end_a, j, end_j, equal in sorted(found)]
            if rows:
                kind = batch.schema.field("doc_id").type
                columns = [pa.array(values, kind if n < 2 else pa.int64()) for n, values in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(columns, names=PASSAGE)


def _passages_of(x: _Stretch, y: _Stretch, a: np.ndarray, b: np.ndarray, sizes: list[int]) -> set | None:
    """Passages round all chains of a pair; None if words are needed that the stretches do not hold."""
    links, found, at = list(zip((a - x.begin).tolist(), (b - y.begin).tolist())), set(), 0
    for size in sizes:
        runs = exact_runs(x.words, y.words, links[at : at + size], x.threes, y.threes)
        at += size
        if runs:
            (i, j, _), (u, v, n) = runs[0], runs[-1]
            if not (x.holds(i, u + n) and y.holds(j, v + n)):
                return None
            if u + n - i < LEAST or v + n - j < LEAST:
                continue  # too short for a passage
            for i, end_i, j, end_j, equal in joined_runs(x.words, y.words, runs):
                found.add((i + x.begin, end_i + x.begin, j + y.begin, end_j + y.begin, equal))
    return found


def _kept(frame: DataFrame, label: str) -> DataFrame:
    """The frame saved; its shuffle files go when it is written, as nothing reads them again."""
    with settings(frame.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return saved(frame, label)


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, partner_id, start, end, partner_start, partner_end, n_equal`` of every passage found.

    The partner is a document where seeds of the passage occur first. Of a passage in many documents
    each has a row with one of them or with a few, where seeds at its edges occur first elsewhere.
    """
    key = row_key(column(doc_id), column(text))
    schema = "struct<seeds: array<bigint>, places: array<int>, firsts: int>"
    found = docs.select(key.alias("key"), F.arrow_udf(_seed_rows, schema)(text_of(text)).alias("s"))
    # The number of a row is that of the written table, and stays.
    rows = _kept(found.select(F.monotonically_increasing_id().alias("uid"), "key", "s.seeds", "s.places", "s.firsts"), "passage-seeds")
    first = rows.groupBy("key").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = salted_join(rows.select("key", "uid"), first, ["key"], F.col("uid"), salts=4).where("uid != first").select("uid")
    again = _kept(again, "passage-repeats")
    if not again.isEmpty():
        rows = rows.join(again, "uid", "left_anti")

    def exploded(seeds: Column) -> DataFrame:
        return rows.select("uid", F.explode(seeds).alias("s")).select("uid", F.col("s.seeds").alias("seed"), F.col("s.places").alias("place"))

    zipped = F.arrays_zip("seeds", "places")
    each = exploded(zipped)
    # A document has a seed once here, so no two places are of the same first document.
    shared = exploded(F.slice(zipped, 1, F.col("firsts"))).groupBy("seed").agg(*_first_one(F.col("uid")), F.max("uid").alias("last"))
    shared = _kept(shared.where("anchor != last").drop("last"), "passage-anchors")
    # A hot seed is split by adaptive execution: nothing above the join needs its rows together.
    pairs = _pairs(each.join(shared, "seed"), "passage-chains")
    texts = docs.select(key.alias("key"), column(doc_id).alias("doc_id"), text_of(text).alias("text"))
    if not again.isEmpty():  # one text of each document
        texts = texts.dropDuplicates(["key"])
    names = rows.select("uid", "key")
    found = _align_pairs(pairs.where(F.col("anchor") != STRETCH), names, texts, "passage-rows")
    links = _window_links(pairs.where(F.col("anchor") == STRETCH), found, names, texts)
    if links is not None:
        pairs = _pairs(links, "passage-window-chains").where(F.col("anchor") != STRETCH)
        found = found.unionByName(_align_pairs(pairs, names, texts, "passage-window-rows"))
    return found.drop("uid", "anchor")


def _first_one(uid: Column) -> list[Column]:
    """The first document of a group and the place there; numbers alone, so that the groups are hashed and not sorted."""
    return [F.min(uid).alias("anchor"), F.min_by("place", uid).alias("anchor_place")]


def _pairs(links: DataFrame, label: str) -> DataFrame:
    """``anchor, uid, anchor_places, places, sizes`` (of the chains) of all links (``anchor, uid, anchor_place, place``)."""
    links = links.select("anchor", "uid", "anchor_place", "place").repartition("uid").sortWithinPartitions("uid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chained((batch.to_pandas() for batch in batches), _pair_rows)

    return _kept(links.mapInArrow(run, "anchor bigint, uid bigint, anchor_places array<int>, places array<int>, sizes array<int>"), label)


def _align_pairs(pairs: DataFrame, names: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """Passages of all pairs, with the numbers of both documents.

    The words round the chains are aligned. Pairs whose runs may go on beyond them are aligned
    again with whole texts, so the passages are those of whole texts.
    """
    near = _kept(_align_within(pairs, names, texts, MARGIN), label)
    longer = near.where(F.col("start").isNull()).select("anchor", "uid")
    near = near.where(F.col("start").isNotNull())
    if longer.isEmpty():
        return near
    again = _align_within(pairs.join(longer, ["anchor", "uid"], "left_semi"), names, texts, None)
    return near.unionByName(_kept(again, label + "-whole"))


def _align_within(pairs: DataFrame, names: DataFrame, texts: DataFrame, margin: int | None) -> DataFrame:
    # Few anchors have more than one part, and only those are repeated for the join.
    sizes = pairs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP)
    sizes = sizes.select("anchor", F.ceil(F.col("n") / GROUP).alias("parts"))
    dealt = salted_join(pairs, sizes, ["anchor"], F.col("uid"), salts=16, how="left")
    part = F.coalesce(F.pmod(F.xxhash64("uid"), F.col("parts")), F.lit(0).cast("bigint"))
    dealt = dealt.select("anchor", part.alias("part"), "uid", "anchor_places", "places", "sizes")
    leaders = dealt.groupBy("anchor", "part").agg(
        F.min(F.array_min("anchor_places")).alias("low"), F.max(F.array_max("anchor_places")).alias("high")
    ).withColumn("uid", F.col("anchor"))
    dealt = dealt.withColumn("low", F.array_min("places")).withColumn("high", F.array_max("places"))
    wanted = F.struct("anchor", "part", "low", "high", "anchor_places", "places", "sizes")
    # One row for each text, so that it is read once for all its pairs.
    placed = dealt.unionByName(leaders, allowMissingColumns=True).groupBy("uid").agg(F.collect_list(wanted).alias("wanted"))
    # Hashed, as a merge would sort the texts.
    both = texts.join(placed.join(names, "uid").hint("shuffle_hash"), "key").select("doc_id", "uid", "text", "wanted")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    sent = both.mapInArrow(
        _cut_out(margin),
        "anchor bigint, part bigint, anchor_places array<int>, places array<int>, sizes array<int>,"
        f" doc_id {id_type}, uid bigint, text string, begin int, behind boolean",
    )
    ordered = sent.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.col("sizes").isNotNull(), "uid")
    kinds = [id_type, id_type, *["bigint"] * (len(PASSAGE) - 2)]
    return ordered.mapInArrow(_aligned, ", ".join(map(" ".join, zip(PASSAGE, kinds))))


def _still_open(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        frame["open"] = [
            bool((windows_in(row.starts, row.ends, n := int(row.ends.max())) & ~windows_in(row.covered_starts, row.covered_ends, n)).any())
            for row in frame.itertuples()
        ]
        yield frame


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash and place of each window of ``LEAST`` words in a stretch, whether no passage covers it, and whether no equal one is before it."""
    for frame in batches:
        rows = list(frame.drop(columns="text").itertuples())
        for begin, hashes, first, _, _ in _chunks(list(frame["text"])):
            values = shingles(hashes, LEAST).view(np.int64)
            found = []
            for row, low, high in zip(rows[begin:], first[:-1], first[1:]):
                n = high - low - LEAST + 1
                if n > 0:
                    place = np.flatnonzero(windows_in(row.starts, row.ends, n))
                    bare = ~windows_in(row.covered_starts, row.covered_ends, n)
                    found.append((values[low + place], np.full(len(place), row.uid), place, bare[place]))
            if found:
                columns = dict(zip(("seed", "uid", "place", "open"), map(np.concatenate, zip(*found))))
                yield pd.DataFrame(columns | {"new": first_ones(columns["seed"], columns["uid"])})


def _window_links(stretched: DataFrame, found: DataFrame, names: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links of the windows that no passage covers to the window's first occurrence; None if all are covered."""
    covered = found.select("uid", "start", "end").union(found.select("anchor", "partner_start", "partner_end")).distinct()
    covered = covered.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("covered"))
    own = stretched.join(covered, "uid", "left")
    none = F.array().cast("array<bigint>")
    own = own.select(
        "uid", F.col("anchor_places").alias("starts"), F.col("places").alias("ends"),
        F.coalesce("covered.start", none).alias("covered_starts"), F.coalesce("covered.end", none).alias("covered_ends"),
    )
    own = _kept(own.mapInPandas(_still_open, own.schema.simpleString()[7:-1].replace(":", " ") + ", open boolean"), "passage-stretches")
    if own.where("open").isEmpty():
        return None
    read = texts.join(own.drop("open").join(names, "uid").hint("shuffle_hash"), "key").select("uid", "text", "starts", "ends", "covered_starts", "covered_ends")
    each = _kept(read.mapInPandas(_windows, "seed bigint, uid bigint, place int, open boolean, new boolean"), "passage-windows")
    first = each.groupBy("seed").agg(*_first_one(F.when(F.col("new"), F.col("uid"))), F.max("uid").alias("last"), F.max("open").alias("open"))
    first = first.where("open and anchor != last").drop("last", "open")
    return each.where("open").join(first, "seed").where("uid != anchor")
