"""Exact top-k search by inner product with a vector-approximation file.

Each component x becomes the whole number floor(scale * x). Vectors are kept in blocks; a block holds
the number of a quantised cell (one byte) for each vector and dimension beside the exact components.
For a query, the cells' limits bound every inner product from above. The bounds of a block are
scanned first; then exact vectors are read in the order of their bounds, the most promising first,
until no bound left reaches the k-th score. Blocks searched one after the other pass that score on.

All queries meet all vectors, in blocks: a task has one group of queries and a few blocks. It returns
k results for each query at most; one aggregation merges them.

Defined results: vectors that are NULL, empty, or hold NULL or a component that is not finite (also
after scaling), and rows without id, take no part. Vectors are compared with those of their own
length. Rows that repeat a query's id are no candidates for it; other repeated rows count one by
one, and a repeated query row is answered each time. Ties go to the smaller id. Scores beyond a long
are limited to its range.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveylake.llm.common import column, saved

CELLS = 64
BLOCK = 2048  # vectors in one block
TURN = 4  # blocks that one task searches one after the other
QUERIES = 2048  # queries in one task
FIRST = 32  # exact vectors read at first; then twice as many each time
LONG = 2**63 - 1


def quantise(exact: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of every component, and the lowest and highest value in each cell of each dimension."""
    low, high = exact.min(axis=0), exact.max(axis=0)
    share = (exact - low) / np.where(high > low, high - low, 1.0)
    cells = np.minimum((share * CELLS).astype(np.int64), CELLS - 1)
    lower, upper = np.full((CELLS, exact.shape[1]), np.inf), np.full((CELLS, exact.shape[1]), -np.inf)
    dims = np.broadcast_to(np.arange(exact.shape[1]), cells.shape)
    np.minimum.at(lower, (cells, dims), exact)
    np.maximum.at(upper, (cells, dims), exact)
    return cells.astype(np.uint8), lower, upper


def upper_bounds(queries: np.ndarray, cells: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """What the inner product of each query with each approximated vector can be at most."""
    dims = np.arange(cells.shape[1])
    return np.maximum(queries, 0.0) @ upper[cells, dims].T + np.minimum(queries, 0.0) @ lower[cells, dims].T


def _exact_products(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of numbers too large for doubles, as whole numbers limited to a long."""
    whole = [int(x) for x in query]
    return np.array([min(LONG, max(-LONG - 1, sum(a * int(b) for a, b in zip(whole, v)))) for v in vectors], dtype=np.int64)


class Search:
    """The best results of a group of queries while blocks pass by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        none = np.zeros(0, dtype=np.int64)
        self.best = [(none, none)] * len(ids)  # scores and ids, best first
        self.exact_reads = 0

    def block(self, ids: np.ndarray, exact: np.ndarray, cells: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> None:
        largest = float(np.abs(exact).max()) * float(np.abs(self.vectors).max())
        if largest * exact.shape[1] >= 2**53:  # sums in doubles might be rounded: read all vectors
            for q in range(len(self.ids)):
                self._read(q, ids, _exact_products(self.vectors[q], exact))
            return
        for begin in range(0, len(self.ids), 256):
            above = upper_bounds(self.vectors[begin : begin + 256], cells, lower, upper)
            for q, bound in enumerate(above, begin):
                order = np.argsort(-bound, kind="stable")
                at, step = 0, FIRST
                while at < len(order) and not self._certain(q, bound[order[at]]):
                    part = order[at : at + step]
                    self._read(q, ids[part], (exact[part] @ self.vectors[q]).astype(np.int64))
                    at, step = at + step, step * 2

    def _certain(self, q: int, bound: float) -> bool:
        scores = self.best[q][0]
        return len(scores) == self.k and bound < scores[-1]

    def _read(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        self.exact_reads += len(ids)
        other = ids != self.ids[q]
        scores = np.concatenate([self.best[q][0], scores[other]])
        ids = np.concatenate([self.best[q][1], ids[other]])
        # The complement reverses the order without the overflow that a minus has at the smallest long.
        top = np.lexsort((ids, ~scores))[: self.k]
        self.best[q] = (scores[top], ids[top])


def _groups(rows: DataFrame, count: int, size: int, with_cells: bool) -> DataFrame:
    """The vectors in groups of ``size``: one row for each group, numbered without gaps by ``number``."""
    schema = "dims int, place bigint, ids binary, exact binary" + (", cells binary, lower binary, upper binary" if with_cells else "")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: dict[int, list[tuple[int, np.ndarray]]] = {}

        def row(dims: int) -> pd.DataFrame:
            nonlocal made
            members = waiting.pop(dims)
            exact = np.stack([vector for _, vector in members])
            data = {"dims": dims, "place": (part << 32) + made, "ids": np.array([i for i, _ in members], dtype=np.int64).tobytes(), "exact": exact.tobytes()}
            if with_cells:
                data |= dict(zip(("cells", "lower", "upper"), (x.tobytes() for x in quantise(exact))))
            made += 1
            return pd.DataFrame([data])

        for batch in batches:
            for i, vector in zip(batch["id"], batch["vector"]):
                waiting.setdefault(len(vector), []).append((i, np.asarray(vector, dtype=np.float64)))
                if len(waiting[len(vector)]) == size:
                    yield row(len(vector))
        for dims in list(waiting):
            yield row(dims)

    return rows.repartition(max(1, -(-count // size))).mapInPandas(pack, schema)


def _searcher(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(queries: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found = []
        for q in queries.itertuples():
            ids = np.frombuffer(q.ids, dtype=np.int64)
            search = Search(ids, np.frombuffer(q.exact).reshape(len(ids), q.dims), k)
            for b in blocks.sort_values("place").itertuples():
                if b.dims == q.dims:
                    exact = np.frombuffer(b.exact).reshape(-1, b.dims)
                    cells = np.frombuffer(b.cells, dtype=np.uint8).reshape(exact.shape)
                    limits = [np.frombuffer(x).reshape(CELLS, b.dims) for x in (b.lower, b.upper)]
                    search.block(np.frombuffer(b.ids, dtype=np.int64), exact, cells, *limits)
            for i, (scores, others) in enumerate(search.best):
                found.append(pd.DataFrame({"place": q.place, "i": i, "query_id": ids[i], "vec_id": others, "score": scores}))
        if not found:
            return pd.DataFrame({name: np.zeros(0, dtype=np.int64) for name in ("place", "i", "query_id", "vec_id", "score")})
        return pd.concat(found)

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best other rows for every row that ``is_query`` admits."""
    scaled = F.transform(column(embedding), lambda x: x.cast("double") * F.lit(scale))
    good = F.forall(scaled, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    rows = vectors.where(column(vec_id).isNotNull() & column(embedding).isNotNull() & (F.size(column(embedding)) > 0)).select(
        column(vec_id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), scaled.alias("vector"), good.alias("good")
    )
    rows = rows.where("good").drop("good")
    # Whole numbers as doubles, for which Spark's own floor would give a long that may overflow.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)))
    number = rows.groupBy().agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    blocks = saved(_groups(rows.select("id", "vector"), number["n"], BLOCK, True), "va-blocks")
    queries = saved(_groups(rows.where("is_query").select("id", "vector"), number["q"], QUERIES, False), "va-queries")
    turns = max(1, -(-number["n"] // (BLOCK * TURN)))
    asked = max(1, -(-number["q"] // QUERIES))
    # Places are (part << 32) + number; parts are of even size, so their low bits deal groups evenly.
    part = F.shiftright("place", 32)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.withColumn("group", F.pmod(part, F.lit(asked)).cast("int")).withColumn("turn", every(turns))
    right = blocks.withColumn("turn", F.pmod(part, F.lit(turns)).cast("int")).withColumn("group", every(asked))
    met = left.groupBy("group", "turn").cogroup(right.groupBy("group", "turn"))
    found = met.applyInPandas(_searcher(k), "place bigint, i bigint, query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("place", "i").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
