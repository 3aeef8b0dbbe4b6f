"""Document scores by masked pseudo-likelihood: every token predicted from both of its sides.

A token is a word's bucket (lower case, split at ASCII white space, hashed). A small network reads the
two tokens on either side: their embeddings are concatenated, pass one hidden layer, and predict the
bucket in two steps, its first half and then its second half given the first. The word's share of its
bucket's occurrences in the corpus, counted in Spark, is the third factor, so the vocabulary grows with
the corpus. The sum of the logarithms of these conditional probabilities over all tokens scores a document.

Training is data parallel: in each round every partition goes through all of its documents and takes gradient
steps from the common weights; the weights of all partitions are then averaged, weighted by their
learned tokens, and start the next round. The rounds take turns at the places of a text, so every
token is learned once; the network never sees the token it predicts.

Texts are split and hashed once: ``coded`` writes, for each chunk of texts, its distinct words and the
number of each token among them, from which training, counting and scoring read. A chunk asks once for
each of its distinct words: its words go as packed arrays to the parts of the vocabulary, where they are
counted, and their shares come back in the same order. Averages are taken over partitions, so weights and scores
depend, within the noise of training, on how the table is cut into them.

Defined results: a text that is NULL or has no word has no tokens, sum 0 and a NULL mean. Repeated rows are
scored each; other columns are passed on. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, fresh, saved
from surveylake.llm.words import word_hashes
from surveylake.session import settings

HALF = 64  # classes of each half of a bucket's number
BUCKETS = HALF * HALF
SIDE = 2  # tokens read on either side
EMBEDDING, HIDDEN = 16, 32
ROUNDS = 2
BATCH, RATE = 4096, 0.05
CHUNK_CHARS = 2_000_000
SCORED = 8192  # tokens scored at once
PIECES, LEVEL = 8, 64  # the weights are averaged in so many pieces, and first in so many parts
KEY = 32  # bytes of a text's key
PART_WORDS = 1_000_000  # words of all chunks that one part of the vocabulary counts
CHUNKS_AT_ONCE = {"spark.sql.execution.arrow.maxRecordsPerBatch": "32"}  # a chunk is up to some MB

_SHAPES = {
    "tokens": (BUCKETS + 1, EMBEDDING),  # the last one stands for what lies outside of the text
    "inner": (2 * SIDE * EMBEDDING, HIDDEN),
    "inner_bias": (HIDDEN,),
    "first": (HIDDEN, HALF),
    "first_bias": (HALF,),
    "given": (HALF, HIDDEN),
    "second": (HIDDEN, HALF),
    "second_bias": (HALF,),
}
_SIZE = sum(int(np.prod(shape)) for shape in _SHAPES.values())


class Network:
    """The weights as views of one vector."""

    def __init__(self, flat: np.ndarray) -> None:
        self.flat, at = flat, 0
        for name, shape in _SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape))
            at += size

    @classmethod
    def start(cls) -> Network:
        rng = np.random.default_rng(5)
        network = cls(np.zeros(_SIZE, dtype=np.float32))
        for name, shape in _SHAPES.items():
            if len(shape) == 2:
                scale = 0.5 if name == "tokens" else 1 / np.sqrt(shape[0])
                getattr(network, name)[:] = rng.normal(0, scale, shape)
        network.given[:] *= 0.1
        return network

    def _forward(self, around: np.ndarray, target: np.ndarray):
        """Layers with a row for each token; scores with a row for each class, over which they are summed fastest."""
        inputs = self.tokens.take(around.ravel(), axis=0).reshape(len(around), -1)
        hidden = inputs @ self.inner
        hidden += self.inner_bias
        np.maximum(hidden, 0, out=hidden)
        high, low = target // HALF, target % HALF
        first = self.first.T @ hidden.T
        first += self.first_bias[:, None]
        knowing = self.given.take(high, axis=0)
        knowing += hidden
        np.maximum(knowing, 0, out=knowing)
        second = self.second.T @ knowing.T
        second += self.second_bias[:, None]
        return inputs, hidden, high, low, first, knowing, second

    def log_probability(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        *_, high, low, first, _, second = self._forward(around, target)
        return _log_share(first, high) + _log_share(second, low)

    def learn(self, around: np.ndarray, target: np.ndarray, squares: Network) -> None:
        """One step of Adagrad on the mean log-probability."""
        inputs, hidden, high, low, first, knowing, second = self._forward(around, target)
        d_second, d_first = _error(second, low), _error(first, high)
        d_knowing = d_second.T @ self.second.T
        d_knowing *= knowing > 0
        d_hidden = d_first.T @ self.first.T
        d_hidden += d_knowing
        d_hidden *= hidden > 0
        d_inputs = (self.inner @ d_hidden.T).reshape(2 * SIDE, EMBEDDING, -1)
        step = Network(np.zeros(_SIZE, dtype=np.float32))
        _sum_by_token(around, d_inputs, step.tokens)
        _sum_by(high, d_knowing, step.given)
        step.inner[:], step.inner_bias[:] = inputs.T @ d_hidden, d_hidden.sum(axis=0)
        step.first[:], step.first_bias[:] = (d_first @ hidden).T, d_first.sum(axis=1)
        step.second[:], step.second_bias[:] = (d_second @ knowing).T, d_second.sum(axis=1)
        squares.flat += step.flat * step.flat
        self.flat -= RATE * step.flat / (np.sqrt(squares.flat) + 1e-8)


def _log_share(scores: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Logarithm of each column's softmax at one place."""
    scores -= scores.max(axis=0)
    own = scores[taken, np.arange(len(taken))]
    return own - np.log(np.exp(scores, out=scores).sum(axis=0))


def _error(scores: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Each column's softmax, less one at the place taken, divided by the number of columns."""
    n = len(taken)
    scores -= scores.max(axis=0)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=0) * np.float32(n)
    scores[taken, np.arange(n)] -= np.float32(1 / n)
    return scores


def _sum_by_token(around: np.ndarray, changes: np.ndarray, sums: np.ndarray) -> None:
    """Add up changes by side, component and row for each token: counted, as most tokens of a batch are too few to sort."""
    tokens = around.T.ravel().astype(np.intp)
    for i in range(sums.shape[1]):
        sums[:, i] = np.bincount(tokens, changes[:, i].ravel(), len(sums))


def _sum_by(places: np.ndarray, rows: np.ndarray, sums: np.ndarray) -> None:
    """Add up the rows of each place, of which there are few: below 65,536 and so sorted digit by digit."""
    short = places.astype(np.uint16)
    order = np.argsort(short, kind="stable")
    ordered = short[order]
    starts = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] + np.uint16(1)))
    sums[ordered[starts]] = np.add.reduceat(rows.take(order, axis=0), starts, axis=0)


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    part, chars = [], 0
    for text in texts:
        part.append((text or "").lower())
        chars += len(part[-1])
        if chars >= CHUNK_CHARS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def _laid_out(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token numbers padded with ``SIDE`` outside tokens round each text, each token's place there, and its text."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    padded = np.full(len(tokens) + 2 * SIDE * len(sizes), BUCKETS, dtype=np.int32)
    place = np.arange(len(tokens)) + SIDE * (2 * owner + 1)
    padded[place] = tokens
    return padded, place, owner


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes.view(np.uint64) % np.uint64(BUCKETS)).astype(np.int32)


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, first, _, _ = word_hashes(texts)
    return _laid_out(_buckets(hashes), np.diff(first))


_AROUND = np.array([*range(-SIDE, 0), *range(1, SIDE + 1)])


def _log_probabilities(padded: np.ndarray, place: np.ndarray, network: Network) -> np.ndarray:
    logs = np.zeros(len(place))
    for at in range(0, len(place), SCORED):
        here = place[at : at + SCORED]
        logs[at : at + SCORED] = network.log_probability(padded[here[:, None] + _AROUND], padded[here])
    return logs


def score(texts: list[str | None], network: Network) -> tuple[np.ndarray, np.ndarray]:
    """Number of tokens and summed log-probability of each text."""
    numbers, sums = [], []
    for part in _chunks(texts):
        padded, place, owner = _tokens(part)
        numbers.append(np.bincount(owner, minlength=len(part)))
        sums.append(np.bincount(owner, weights=_log_probabilities(padded, place, network), minlength=len(part)))
    none = np.zeros(0)
    return np.concatenate([none.astype(np.int64), *numbers]), np.concatenate([none, *sums])


def train(batches: Iterator[list[str | None]], network: Network, turn: int, rounds: int = 1) -> int:
    """Go through all texts once and learn the tokens whose turn it is among ``rounds``; returns their number."""
    return _train_on((_tokens(part) for texts in batches for part in _chunks(texts)), network, turn, rounds)


def _train_on(chunks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], network: Network, turn: int, rounds: int) -> int:
    squares = Network(np.full(_SIZE, 1e-6, dtype=np.float32))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held = learned = 0

    def learn() -> None:
        around, target = (np.concatenate(x) for x in zip(*waiting))
        for at in range(0, len(target), BATCH):
            network.learn(around[at : at + BATCH], target[at : at + BATCH], squares)

    for padded, place, owner in chunks:
        ends = np.cumsum(np.bincount(owner))
        within = np.arange(len(place)) - np.concatenate([[0], ends])[owner]
        here = place[within % rounds == turn]
        waiting.append((padded[here[:, None] + _AROUND], padded[here]))
        held += len(here)
        learned += len(here)
        if held >= BATCH:
            learn()
            waiting, held = [], 0
    if held:
        learn()
    return learned


def _text_key(text: str) -> Column:
    return F.unhex(F.sha2(column(text).cast("binary"), 256))


def coded(docs: DataFrame, text: str = "text") -> DataFrame:
    """A written table of chunks of texts, each split and hashed once.

    A chunk has the keys and sizes of its texts, its distinct words in order with their counts, and
    each token's place among these, in two bytes up to 65,536 distinct words and in four beyond.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 33
        for frame in frames:
            keys, at = list(frame["key"]), 0
            for part in _chunks(list(frame["text"])):
                hashes, first, _, _ = word_hashes(part)
                words, codes, counts = np.unique(hashes.view(np.int64), return_inverse=True, return_counts=True)
                yield pd.DataFrame({
                    "chunk": [number],
                    "keys": [b"".join(keys[at : at + len(part)])],
                    "sizes": [np.diff(first).astype(np.int64)],
                    "codes": [codes.astype(_code_type(len(words))).tobytes()],
                    "words": [words],
                    "counts": [counts.astype(np.int64)],
                })
                number, at = number + 1, at + len(part)

    present = docs.where(column(text).isNotNull()).select(_text_key(text).alias("key"), column(text).alias("text"))
    schema = "chunk bigint, keys binary, sizes array<bigint>, codes binary, words array<bigint>, counts array<bigint>"
    return saved(present.mapInPandas(run, schema), "lm-chunks")


def _code_type(n_words: int) -> type:
    return np.uint16 if n_words <= 1 << 16 else np.uint32


def _codes(codes: bytes, n_words: int) -> np.ndarray:
    return np.frombuffer(codes, dtype=_code_type(n_words))


_PIECE = "piece int, weight double, sums binary"


def _averaged(trained: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted sums of the weight vectors' pieces with equal keys, added up one by one."""

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, list] = {}
        for frame in rows:
            for row in frame.itertuples():
                total = totals.setdefault(row.piece, [0.0, 0.0])
                total[0] += row.weight
                total[1] = total[1] + np.frombuffer(row.sums)
        yield pd.DataFrame(
            [(piece, weight, sums.tobytes()) for piece, (weight, sums) in totals.items()], columns=["piece", "weight", "sums"]
        )

    return trained.repartition(*keys).mapInPandas(run, _PIECE)


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, chunks: DataFrame | None = None) -> Network:
    """Weights trained on all documents, whose ``coded`` chunks may be given."""
    spark = docs.sparkSession
    network = Network.start()
    chunks = coded(docs, text) if chunks is None else chunks
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(network.flat)

        def run(batches: Iterator[pd.DataFrame], turn: int = turn, shared=shared) -> Iterator[pd.DataFrame]:
            own = Network(shared.value.copy())
            tokens = (_laid_out(_buckets(row.words)[_codes(row.codes, len(row.words))], row.sizes) for frame in batches for row in frame.itertuples())
            n = _train_on(tokens, own, turn, rounds)
            if n:
                pieces = np.array_split(own.flat.astype(np.float64) * n, PIECES)
                part = TaskContext.get().partitionId()
                yield pd.DataFrame({"piece": range(PIECES), "part": part % LEVEL, "weight": float(n), "sums": [p.tobytes() for p in pieces]})

        with settings(spark, CHUNKS_AT_ONCE):
            trained = chunks.select("sizes", "codes", "words").mapInPandas(run, "piece int, part int, weight double, sums binary")
            first = _averaged(trained, ["piece", "part"])
            rows = sorted(_averaged(first, ["piece"]).collect(), key=lambda row: row.piece)
        if not rows:  # no document has a word
            break
        flat = np.concatenate([np.frombuffer(row.sums) / row.weight for row in rows])
        network = Network(flat.astype(np.float32))
    return network


def _parts(words: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the vocabulary, an even range of hashes, starts in a chunk's ordered words."""
    high = (words.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
    part = (high * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])


def _shares(chunks: DataFrame, parts: int) -> DataFrame:
    """``chunk, part, shares``: for the chunk's words in a part, the logarithms of their shares of their buckets.

    A word is in one part, so its count there is that of the corpus; parts are of even size, as a
    word is in it once for each chunk however often it occurs.
    """
    each = chunks.select(F.explode(F.arrays_zip("words", "counts")).alias("w"))
    buckets = each.groupBy(F.pmod("w.words", F.lit(BUCKETS)).alias("bucket")).agg(F.sum("w.counts").alias("total"))
    totals = np.zeros(BUCKETS)
    for row in buckets.collect():  # one row for each bucket
        totals[row.bucket] = row.total
    shared = chunks.sparkSession.sparkContext.broadcast(totals)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.itertuples():
                first, words, counts = _parts(row.words, parts), row.words, row.counts.astype(np.uint32)
                some = np.flatnonzero(np.diff(first))
                yield pd.DataFrame({
                    "chunk": row.chunk,
                    "part": some,
                    "words": [words[first[i] : first[i + 1]].tobytes() for i in some],
                    "counts": [counts[first[i] : first[i + 1]].tobytes() for i in some],
                })

    def count(group: pd.DataFrame) -> pd.DataFrame:
        words = np.frombuffer(b"".join(group["words"]), dtype=np.int64)
        counts = np.frombuffer(b"".join(group["counts"]), dtype=np.uint32)
        distinct, place = np.unique(words, return_inverse=True)
        share = np.log(np.bincount(place, weights=counts) / shared.value[_buckets(distinct)])[place]
        ends = np.cumsum([len(asked) // 8 for asked in group["words"]])[:-1]
        return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "shares": [s.tobytes() for s in np.split(share, ends)]})

    asked = chunks.select("chunk", "words", "counts").mapInPandas(ask, "chunk bigint, part bigint, words binary, counts binary")
    return asked.groupBy("part").applyInPandas(count, "chunk bigint, part bigint, shares binary")


def _scored_chunks(chunks: DataFrame, network: Network) -> DataFrame:
    """``key, n, log``: tokens and summed log-probability, of the words themselves, of each distinct text."""
    spark = chunks.sparkSession
    asked = chunks.agg(F.sum(F.size("words").cast("long")).alias("n")).first().n or 0
    parts = max(1, -(-asked // PART_WORDS))
    # At most one entry for each part or distinct word of one chunk.
    answers = _shares(chunks, parts).groupBy("chunk").agg(F.collect_list(F.struct("part", "shares")).alias("answers"))
    buckets = F.transform("words", lambda word: F.pmod(word, F.lit(BUCKETS)).cast("smallint"))
    both = chunks.select("chunk", "keys", "sizes", "codes", buckets.alias("buckets")).join(answers, "chunk", "left")
    weights = spark.sparkContext.broadcast(network.flat)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Network(weights.value)
        for frame in batches:
            for row in frame.itertuples():
                # Parts are ranges in the order of a chunk's words, so their answers line up.
                found = sorted(row.answers, key=lambda answer: answer["part"]) if len(row.buckets) else []
                share = np.frombuffer(b"".join(answer["shares"] for answer in found))
                codes = _codes(row.codes, len(row.buckets))
                padded, place, owner = _laid_out(row.buckets.astype(np.int32)[codes], row.sizes)
                n = len(row.sizes)
                logs = np.bincount(owner, weights=_log_probabilities(padded, place, own), minlength=n)
                logs += np.bincount(owner, weights=share[codes], minlength=n)
                keys = [row.keys[at : at + KEY] for at in range(0, KEY * n, KEY)]
                yield pd.DataFrame({"key": keys, "n": row.sizes, "log": logs})

    with settings(spark, CHUNKS_AT_ONCE):
        found = saved(both.drop("chunk").mapInPandas(run, "key binary, n bigint, log double"), "lm-scores")
    # Equal texts may differ in the last digits, by the tokens beside them in a product of matrices.
    return found.groupBy("key").agg(F.min("n").alias("n"), F.min("log").alias("log"))


def scored_words(docs: DataFrame, network: Network, text: str = "text", chunks: DataFrame | None = None) -> DataFrame:
    """As ``scored``, of the words themselves: with their shares of their buckets in ``docs``, which was learned from."""
    names = ("n_tokens", "log_probability", "mean_log_probability")
    key, n, log = (fresh(docs, name) for name in ("key", "n", "log"))
    texts = _scored_chunks(coded(docs, text) if chunks is None else chunks, network)
    texts = texts.select(F.col("key").alias(key), F.col("n").alias(n), F.col("log").alias(log))
    both = docs.withColumn(key, _text_key(text)).join(texts, key, "left")
    number, whole = F.coalesce(column(n), F.lit(0)), F.coalesce(column(log), F.lit(0.0))
    return both.select(
        *[column(name) for name in docs.columns if name.lower() not in names],
        number.alias(names[0]), whole.alias(names[1]), F.try_divide(whole, number).alias(names[2]),
    )


def scored(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """All rows with ``n_tokens``, ``log_probability`` and ``mean_log_probability`` (replaced, if there) of the buckets."""
    shared = docs.sparkSession.sparkContext.broadcast(network.flat)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Network(shared.value)
        for batch in batches:
            numbers, sums = score([t if isinstance(t, str) else None for t in batch], own)
            yield pd.DataFrame({"n_tokens": numbers, "log_probability": sums})

    names = ("n_tokens", "log_probability", "mean_log_probability")
    kept = [name for name in docs.columns if name.lower() not in names]
    found = fresh(docs, "found")
    with_score = docs.withColumn(found, F.pandas_udf(run, "n_tokens long, log_probability double")(column(text)))
    mean = F.try_divide(column(found).getField("log_probability"), column(found).getField("n_tokens"))
    return with_score.select(*map(column, kept), f"{found}.n_tokens", f"{found}.log_probability", mean.alias("mean_log_probability"))
