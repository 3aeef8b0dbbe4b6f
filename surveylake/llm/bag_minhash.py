"""Near-duplicate detection on multisets of word shingles with BagMinHash signatures.

A document is the multiset of its shingles of five words (lower case, split at ASCII white space; a
document of one to four words is one shingle). Each shingle of weight w owns the weight levels 1..w,
cut into the dyadic ranges (0, 1], (1, 2], (2, 4], ... Every range has a Poisson process whose rate is
its length; a point carries a time, a level and a signature component, all hashed from the shingle
and the range, so documents that share a level see the same point. Points above w are thinned out,
and a process stops once its time has passed the largest entry of the signature. The smallest time in
each component collides with the probability of the weighted Jaccard similarity. Bands of the
signature propose pairs, and each is verified on the exact multiset overlap.

Documents with equal multisets form one node. Within a bucket of a band, each node is first compared
with one leader, the member with most company in all its buckets. Where the members of a bucket are
then in more than one component, all of them are compared in blocks: a pair of blocks is one product
of incidence matrices in one task, which returns only links that join components. So no pair of a
bucket is left unseen, and no pair is emitted unless it is such a link.

Defined results: a document that is NULL or has no word is a class of its own. Class ids are the
smallest doc_id of the class (NULL only if all its ids are NULL). Repeated rows are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, row_key, salted_join, saved, text_of
from surveylake.llm.components import components
from surveylake.llm.words import mix, shingles, word_hashes

SIZE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5  # a pair at 0.8 shares a band with probability 0.99995
CHUNK_CHARS = 1_000_000
GROUP = 64  # texts compared with one leader in one group
BLOCK = 512  # texts in one block of a comparison of blocks
COLUMNS = 4096  # shingles in one product of incidence matrices

_SEED = mix(np.arange(4, dtype=np.uint64) + np.uint64(77))


def multiset(hashes: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text in ascending order and how often each occurs."""
    return np.unique(shingles(hashes, size), return_counts=True)


def _uniform(values: np.ndarray) -> np.ndarray:
    return ((values >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], length: int) -> np.ndarray:
    """Smallest point times of each multiset in each component (one row for each multiset)."""
    signature = np.full((len(bags), length), np.inf)
    flat, bound = signature.reshape(-1), np.full(len(bags), np.inf)
    sizes = [len(values) for values, _ in bags]
    if not sum(sizes):
        return signature
    shingle = np.concatenate([values for values, _ in bags])
    weight = np.concatenate([counts for _, counts in bags]).astype(np.int64)
    doc = np.repeat(np.arange(len(bags)), sizes)
    level, states = 0, []
    while len(doc):  # one process for each dyadic range that begins below the weight
        low = 0 if level == 0 else 1 << (level - 1)
        inside = weight > low
        shingle, weight, doc = shingle[inside], weight[inside], doc[inside]
        rate = max(1, low)
        states.append((doc, mix(shingle ^ _SEED[0] ^ mix(np.uint64([level]))), np.minimum(weight, 2 * max(low, 1)) - low, np.full(len(doc), rate)))
        level += 1
    doc, seed, admitted, rate = (np.concatenate(parts) for parts in zip(*states))
    time = np.zeros(len(doc))
    while len(doc):
        seed = seed + np.uint64(0x632BE59BD9B4E019)
        draw = mix(seed)
        time -= np.log(_uniform(draw)) / rate
        alive = time < bound[doc]
        doc, seed, admitted, rate, time, draw = (x[alive] for x in (doc, seed, admitted, rate, time, draw))
        where = mix(draw ^ _SEED[1])
        hit = (rate == 1) | ((mix(draw ^ _SEED[2]) % rate.astype(np.uint64)).astype(np.int64) < admitted)
        place = doc * length + (where % np.uint64(length)).astype(np.int64)
        np.minimum.at(flat, place[hit], time[hit])
        bound = signature.max(axis=1)
    return signature


def band_hashes(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash for each band of each signature; the band's number is part of it."""
    bits = signature.view(np.uint64).reshape(len(signature), bands, rows)
    out = mix(np.arange(bands, dtype=np.uint64) + np.uint64(500))[None, :].repeat(len(signature), axis=0)
    for row in range(rows):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) ^ bits[:, :, row])
    return out.view(np.int64)


def sketch(texts: list[str | None]) -> pd.DataFrame:
    """Digest of the multiset and band hashes of each text; NULL for a text without words."""
    digests: list[bytes | None] = []
    bands: list[np.ndarray | None] = []
    at = 0
    while at < len(texts):
        part, chars = [], 0
        while at < len(texts) and (not part or chars < CHUNK_CHARS):
            part.append((texts[at] or "").lower())
            chars += len(part[-1])
            at += 1
        hashes, first, _, _ = word_hashes(part)
        bags = [multiset(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
        keys = band_hashes(signatures(bags, BANDS * ROWS))
        for (values, counts), row in zip(bags, keys):
            if len(values):
                digests.append(blake2b(values.tobytes() + counts.astype(np.int64).tobytes(), digest_size=16).digest())
                bands.append(row)
            else:
                digests.append(None)
                bands.append(None)
    return pd.DataFrame({"node": digests, "bands": bands})


def _sketches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield sketch(list(batch))


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][left], b[1][right]).sum())
    return shared / max(1, int(a[1].sum()) + int(b[1].sum()) - shared)


def _verify(group: pd.DataFrame) -> pd.DataFrame:
    """Compare the texts of a group with that of its leader."""
    bag = lambda text: multiset(word_hashes([text.lower()])[0])
    lead = bag(group.text[group.is_leader].iloc[0])
    rest = group[~group.is_leader]
    near = [similarity(lead, bag(text)) >= SIMILARITY for text in rest.text]
    return pd.DataFrame({"a": rest.leader[near], "b": rest.node[near]})


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` among the pairs (leader, node) whose multisets overlap enough.

    A leader's pairs are cut into groups of about ``GROUP`` texts; each group has one copy of the
    leader's text, so a leader of any number of nodes is never in one task alone.
    """
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    dealt = salted_join(pairs, sizes, ["leader"], F.col("node"), salts=16).withColumn(
        "part", F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts"))
    )
    members = dealt.select("leader", "part", "node", F.lit(False).alias("is_leader"))
    leaders = dealt.select("leader", "part").distinct().select("leader", "part", F.col("leader").alias("node"), F.lit(True).alias("is_leader"))
    rows = members.unionByName(leaders).join(texts, "node")
    return rows.groupBy("leader", "part").applyInPandas(_verify, "a binary, b binary")


def _elements(text: str) -> np.ndarray:
    """The multiset of a text as a set: each shingle once for each of its weight levels."""
    values, counts = multiset(word_hashes([text.lower()])[0])
    level = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(values, counts) ^ mix(level.astype(np.uint64))


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets, by products of incidence matrices."""
    sizes = [len(x) for x in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner, place = owner[shared], (np.cumsum(count > 1) - 1)[place[shared]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    total = np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(place.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(place, [low, low + COLUMNS])
        matrix = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        matrix[owner[a:b], place[a:b] - low] = 1
        total += matrix[left] @ matrix[right].T
    return total.astype(np.int64)


def _compare(group: pd.DataFrame) -> pd.DataFrame:
    """Links between the two blocks of a group (or within its one block) that join different components."""
    group = group.drop_duplicates(["block", "node"])
    sets = [_elements(text) for text in group["text"]]
    size = np.array([len(x) for x in sets])
    block = group["block"].to_numpy()
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    shared = overlaps(sets, left, right)
    whole = size[left][:, None] + size[right][None, :] - shared
    roots, nodes = list(group["root"]), list(group["node"])
    number = {root: i for i, root in enumerate(dict.fromkeys(roots))}
    root = np.array([number[x] for x in roots])
    parent = list(range(len(number)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    near = (shared >= SIMILARITY * whole - 1e-9) & (root[left][:, None] != root[right][None, :])
    links = []
    for i, j in np.argwhere(near):
        x, y = left[i], right[j]
        a, b = find(root[x]), find(root[y])
        if a != b:
            parent[a] = b
            links.append((nodes[x], nodes[y]))
    return pd.DataFrame(links, columns=["a", "b"])


def _across(shared: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the components of each bucket that has several.

    The members of all buckets with one leader are cut into blocks, and each pair of blocks is
    compared as a whole in one task; a task returns fewer links than it has texts.
    """
    rooted = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("bucket")
    members = rooted.join(several, "bucket").select("leader", "node", "root").distinct()
    sizes = members.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = salted_join(members, sizes, ["leader"], F.col("node"), salts=16)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = dealt.select(
        "leader", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root"
    )
    return met.join(texts, "node").groupBy("leader", "low", "high").applyInPandas(_compare, "a binary, b binary")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: its ``key`` (see ``row_key``), ``doc_id`` and ``class_id``; ``keep`` marks one row of each class."""
    key = row_key(column(doc_id), column(text))
    sketched = F.pandas_udf(_sketches, "node binary, bands array<bigint>")(text_of(text))
    rows = saved(
        docs.select(key.alias("key"), column(doc_id).alias("doc_id"), sketched.alias("s")).select(
            "key", "doc_id", F.coalesce("s.node", "key").alias("node"), "s.bands"
        ),
        "near-rows",
    )
    nodes = rows.where("bands is not null").groupBy("node").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    nodes = saved(nodes, "near-nodes")
    dealt = nodes.select("node", F.explode("bands").alias("bucket"))
    full = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = saved(dealt.join(full, "bucket"), "near-buckets")
    # The leader of a bucket is the member with most company in all its buckets.
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    weighed = shared.join(company, "node")
    leaders = weighed.groupBy("bucket").agg(F.min(F.struct(-F.col("company"), "node")).getField("node").alias("leader"))
    shared = saved(salted_join(shared.select("bucket", "node"), leaders, ["bucket"], F.col("node"), salts=4), "near-leaders")
    wanted = shared.select("node").distinct().join(nodes.select("node", "key"), "node")
    texts = docs.select(key.alias("key"), text_of(text).alias("text")).join(wanted, "key").dropDuplicates(["key"])
    texts = saved(texts.select("node", "text"), "near-texts")
    pairs = shared.where("node != leader").select("leader", "node").distinct()
    links = saved(_verified(pairs, texts), "near-links")
    links = links.unionByName(saved(_across(shared, components(links), texts), "near-links"))
    roots = components(links)
    placed = rows.join(roots, "node", "left").select("key", "doc_id", F.coalesce("root", "node").alias("root"))
    heads = placed.groupBy("root").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).getField("key").alias("head"),
    )
    return salted_join(placed, heads, ["root"], F.col("key")).select(
        "key", "doc_id", "class_id", (F.col("key") == F.col("head")).alias("keep")
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each class of near duplicates, all columns kept.

    The row of the smallest doc_id stays (then of the smallest key); of rows that repeat it in id
    and text, the least by the text of their columns stays, however they are dealt over tasks.
    """
    found = classes(docs, doc_id, text)
    heads = found.where("keep").select(F.col("key").alias("near_key"), F.lit(True).alias("near_head")).distinct()
    whole = F.struct(*map(column, docs.columns))
    own_key = row_key(column(doc_id), column(text)).alias("near_key")
    keyed = docs.select(own_key, F.struct(F.sha2(F.to_json(whole), 256).alias("near_order"), whole.alias("near_row")).alias("near"))
    kept = keyed.join(heads, "near_key").groupBy("near_key").agg(F.min_by("near", "near.near_order").alias("near"))
    return kept.select("near.near_row.*")
