"""The trie of conversations that begin alike, measured by an Euler tour.

Each prefix of a conversation gets a key that does not depend on the conversation: the sum of one
128-bit hash per turn and place, so the keys along a conversation are running sums. Equal keys are
one node. Every node but the root is numbered behind its siblings; each node has an enter and an
exit arc, and the arcs are linked to one list, the tour: enter leads to the first child's enter or,
on a leaf, to the own exit; exit leads to the next sibling's enter or, on the last one, to the
parent's exit. The list is ranked by contraction: in each round coins choose arcs that are spliced out, no
two neighbours together, until a bounded number is left and walked in one task; the spliced arcs
then get their places from their predecessors, last round first. Work over all rounds is a constant
multiple of the arcs, however deep the trie is. Prefix sums over the places give every subtree's leaves and
savings: the sum at its exit less the sum before its enter.

Defined results: turns are ordered by turn, NULL first; turns of one number are ordered by the hash
of their content, and a repeated row is a turn of its own. A NULL role or text is empty. Rows without
a conv_id belong to no conversation and take no part. An empty table has no root and gives no rows.
Texts are hashed whole, whatever their length. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, salted_join, saved, text_of
from surveylake.llm.scan import digests, running

# A list of this many arcs at most is walked in one task.
WALKED = 16_384
LANES = ("lane_0", "lane_1", "lane_2", "lane_3")
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, place`` (from 1), ``content`` (a hash of role and text) and ``chars`` of every turn."""
    role_, text_ = text_of(role), text_of(text)
    content = F.unhex(F.sha2(F.concat(F.char_length(role_).cast("string"), F.lit(":"), role_, text_), 256))
    slim = conversations.where(column(conv_id).isNotNull()).select(
        column(conv_id).cast("bigint").alias("conv_id"), column(turn).alias("turn"), content.alias("content"), F.char_length(text_).alias("chars")
    )
    return running(slim, ["conv_id"], ["turn", "content"], {"place": F.lit(1)}, label="trie-turns").drop("turn")


def restarted(own: DataFrame, shared: Column, from_conv: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    ``shared`` (0 to ``most``) turns at the start come from the conversation ``from_conv`` (all it
    has, if fewer); the own turns after the first ``shared`` follow. Returns the turns and one row for
    each conversation, as a conversation may be left without turns.
    """
    numbered = saved(own, "trie-numbered")
    convs = numbered.where("place = 1").select("conv_id", shared.cast("bigint").alias("shared"), from_conv.alias("origin"))
    opening = numbered.where(F.col("place") <= most).select(F.col("conv_id").alias("origin"), "place", "content", "chars")
    heads = convs.join(opening, "origin").where(F.col("place") <= F.col("shared")).select("conv_id", "place", "content", "chars")
    length = opening.groupBy("origin").agg(F.max("place").alias("length"))
    missing = F.col("shared") - F.least("shared", F.coalesce("length", F.lit(0)))
    short = convs.join(length, "origin", "left").select("conv_id", missing.alias("missing")).where("missing > 0")
    tails = salted_join(numbered.where(F.col("place") > shared), short, ["conv_id"], F.col("place"), salts=16, how="left")
    moved = F.col("place") - F.coalesce("missing", F.lit(0))
    return heads.union(tails.select("conv_id", moved.alias("place"), "content", "chars")), convs.select("conv_id")


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth, *lanes)))


def _members(rows: DataFrame) -> DataFrame:
    """Every turn with the key of the prefix that it ends and of the one before it."""
    hashes = [F.xxhash64("place", "content", F.lit(n)) for n in (1, 2)]
    halves = [half for x in hashes for half in (x.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(x, 32))]
    hashed = rows.select("conv_id", "place", "chars", *(half.alias(f"own_{name}") for half, name in zip(halves, LANES)))
    summed = running(hashed, ["conv_id"], ["place"], {name: f"own_{name}" for name in LANES}, label="trie-prefixes")
    place = F.col("place")
    return summed.select(
        "conv_id",
        place.alias("depth"),
        "chars",
        _key(place, [F.col(name) for name in LANES]).alias("key"),
        _key(place - 1, [F.col(name) - F.col(f"own_{name}") for name in LANES]).alias("parent"),
    )


def list_rank(arcs: DataFrame, walked: int = WALKED) -> DataFrame:
    """``arc, position`` (from 0) of every arc of a list given as ``arc, next``; the last has no next."""
    state = saved(arcs.select("arc", "next", F.lit(1).cast("bigint").alias("reach")), "tour-state")
    spliced: list[DataFrame] = []
    while state.count() > walked:

        def chosen(arc: str) -> Column:
            return F.coalesce(F.xxhash64(arc, F.lit(len(spliced))).bitwiseAND(1) == 1, F.lit(False)) & F.col(arc).isNotNull()

        leaving = state.where(chosen("arc"))
        ahead = state.where(~chosen("arc") & chosen("next")).select(F.col("arc").alias("before"), F.col("next").alias("arc"), F.col("reach").alias("step"))
        met = saved(leaving.join(ahead, "arc", "left"), "tour-met")
        taken = met.where("before IS NOT NULL")
        state = saved(
            state.where(~chosen("arc") & ~chosen("next"))
            .union(met.where("before IS NULL").select("arc", "next", "reach"))
            .union(taken.select("before", "next", F.col("step") + F.col("reach"))),
            "tour-state",
        )
        spliced.append(taken.select("arc", "before", "step"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [batch for batch in batches if len(batch)]
        if not rows:
            return
        rows = pd.concat(rows)
        after = {arc: (None if pd.isna(next_) else int(next_), int(reach)) for arc, next_, reach in zip(rows["arc"], rows["next"], rows["reach"])}
        arc: int | None = next(iter(set(after) - {next_ for next_, _ in after.values()}))
        at, places = 0, {}
        while arc is not None:
            places[arc] = at
            arc, reach = after[arc]
            at += reach
        yield pd.DataFrame({"arc": list(places), "position": list(places.values())})

    ranked = saved(state.coalesce(1).mapInPandas(walk, "arc bigint, position bigint"), "tour-ranked")
    for taken in reversed(spliced):
        known = ranked.select(F.col("arc").alias("before"), F.col("position").alias("base"))
        later = saved(taken.join(known, "before").select("arc", (F.col("base") + F.col("step")).alias("position")), "tour-ranked")
        ranked = ranked.union(later)
    return ranked


def _linked(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered nodes with their parent's member and children, and the arcs of the tour."""
    attributes = ["key", "parent", "depth", "conv_id", "n_convs", "chars"]
    above = nodes.select(F.col("key").alias("family"), F.lit(0).alias("kind"), *attributes)
    below = nodes.where("parent IS NOT NULL").select(F.col("parent").alias("family"), F.lit(1).alias("kind"), *attributes)
    # A node stands at the head of its children, so its member reaches them as a running sum.
    seen = running(
        above.union(below), ["family"], ["kind", "key"],
        sums={"parent_conv_id": F.when(F.col("kind") == 0, F.col("conv_id")).otherwise(0)}, overall={"id": "kind"}, label="trie-families",
    )
    seen = saved(seen, "trie-numbers")
    children = seen.where("kind = 1").groupBy(F.col("family").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"), F.min("id").alias("first"), F.max("id").alias("last")
    )
    root = seen.where("kind = 0 AND parent IS NULL").select(*attributes, F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(0).cast("bigint").alias("id"))
    numbered = seen.where("kind = 1").select(*attributes, "parent_conv_id", "id").union(root)
    whole = saved(numbered.join(children, "key", "left"), "trie-nodes")
    here = F.col("id") * 2
    enters = whole.select(here.alias("arc"), F.coalesce(F.col("first") * 2, here + 1).alias("next"))
    upward = whole.where("last IS NOT NULL").select(F.col("last").alias("id"), (here + 1).alias("up"))
    onward = F.when(F.col("id") > 0, F.coalesce("up", here + 2))
    exits = whole.select("id").join(upward, "id", "left").select((here + 1).alias("arc"), onward.alias("next"))
    return whole, enters.union(exits)


def trie(rows: DataFrame, convs: DataFrame, walked: int = WALKED) -> DataFrame:
    """The nodes of the trie over turns (``conv_id, place, content, chars``) of the conversations ``convs``.

    One row for each node: ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (over its subtree), ``ends_sha256`` (of the members that end here).
    """
    start = _key(F.lit(0), [F.lit(0)] * len(LANES))
    members = saved(_members(rows), "trie-members")
    nodes = members.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("chars").cast("bigint").alias("chars"),
    )
    top = convs.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    nothing = F.lit(None).cast("binary")
    root = top.select(start.alias("key"), nothing.alias("parent"), F.lit(0).cast("bigint").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("bigint").alias("chars"))
    whole, arcs = _linked(saved(nodes.union(root), "trie-nodes"))

    saving = (F.col("n_convs") - 1) * F.col("chars")
    at_enter = whole.select(
        (F.col("id") * 2).alias("arc"), F.col("first").isNull().cast("bigint").alias("leaf"), saving.alias("saving")
    )
    toured = list_rank(arcs, walked).join(at_enter, "arc", "left").na.fill(0, ["leaf", "saving"])
    summed = running(toured, [], ["position"], overall={"n_leaves": "leaf", "saved_tokens": "saving"}, label="tour-sums")

    def within(total: str, own: str) -> Column:
        return F.sum(F.when(F.col("arc") % 2 == 1, F.col(total)).otherwise(F.col(own) - F.col(total))).alias(total)

    subtrees = summed.groupBy(F.shiftright("arc", 1).alias("id")).agg(within("n_leaves", "leaf"), within("saved_tokens", "saving"))

    last = members.groupBy("conv_id").agg(F.max(F.struct("depth", "key"))["key"].alias("key"))
    ends = convs.join(last, "conv_id", "left").select(F.coalesce("key", start).alias("key"), "conv_id", F.col("conv_id").cast("string").alias("name"))
    ended = digests(ends, "key", ["conv_id"], "name", ",", "ends_sha256")
    return whole.join(subtrees, "id").join(ended, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


# DuckDB has no CRC-32; this is its definition, byte by byte and bit by bit.
_CRC32_SQL = """
    xor(4294967295::UBIGINT, list_reduce(
        list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [1, 1, 1, 1, 1, 1, 1, 1]::UBIGINT[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)
        )
    ))::BIGINT"""

# The nodes over ``conversations`` whose first crc32(conv_id) % 6 turns come from conversation conv_id - conv_id % 100.
TRIE_SQL = f"""
    WITH own AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv_id, {_CRC32_SQL} % 6 AS shared, conv_id - conv_id % 100 AS origin, count(*) AS length FROM own GROUP BY conv_id
    ), rebuilt AS (
        SELECT c.conv_id, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.origin AND o.place <= c.shared
        UNION ALL
        SELECT o.conv_id, o.place - c.shared + least(c.shared, coalesce(b.length, 0)), o.role, o.text
        FROM own o JOIN convs c USING (conv_id) LEFT JOIN convs b ON b.conv_id = c.origin WHERE o.place > c.shared
    ), paths AS (
        SELECT conv_id, place AS depth, length(text) AS chars, count(*) OVER (PARTITION BY conv_id) AS total,
            string_agg(md5(length(role) || ':' || role || text), ',') OVER (PARTITION BY conv_id ORDER BY place) AS path
        FROM rebuilt
    ), members AS (
        SELECT conv_id, depth, chars, total, md5(path) AS key FROM paths
        UNION ALL
        SELECT conv_id, 0, 0, (SELECT count(*) FROM rebuilt r WHERE r.conv_id = c.conv_id), '' FROM convs c
    ), nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '')) AS ends_sha256
        FROM members GROUP BY key, depth
    ), linked AS (
        SELECT n.*, p.key AS parent FROM nodes n LEFT JOIN members p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
    ), families AS (
        SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM linked k WHERE k.parent = n.key) AS n_children
        FROM linked n LEFT JOIN nodes p ON p.key = n.parent
    ), subtrees AS (
        SELECT m.key, sum((f.n_children = 0)::INT)::BIGINT AS n_leaves, sum((f.n_convs - 1) * f.chars)::BIGINT AS saved_tokens
        FROM families f JOIN members m ON m.conv_id = f.conv_id AND m.depth <= f.depth GROUP BY m.key
    )
    SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
    FROM families f JOIN subtrees s USING (key)
"""
