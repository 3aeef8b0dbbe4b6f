"""Cheapest repair of the turn structure of conversations with Four-Russians block tables.

The roles of a conversation should read: at most one system turn, then user and assistant in turn.
Edits keep a row (0), change its role to user or assistant (3), delete it (4; a must for blank and
repeated rows) or insert an empty user or assistant turn (3); a truncated row that stays costs 3 more.
An automaton of four states reads the roles, so the costs of repairing the rest of a conversation
are a vector of four numbers for each gap between rows. Less its minimum, only a few dozen such vectors
exist. A table holds, for every vector and every block of ``BLOCK`` row symbols, the vector in front
of the block and the difference of the minima; a conversation is passed from its end by one lookup a
block. The trace expands block after block into the vectors of its gaps and takes, from the front, the
ASCII-least letter among the cheapest edits, which gives the least of all cheapest edit strings.

Conversations are cut into segments of ``SEGMENT`` rows. A segment is summed up by its costs between
every two states; the few segments of one conversation are folded to end vectors, all segments are
traced on their own from every state, and the states in front of them are chosen in a second fold. So
a conversation with a third of all rows is read by many tasks; only its edit string, which is one
value of the result, is put together in one row.

Defined results: a NULL role or text counts as one space. Rows are ordered by turn, NULL first; rows of
one turn by the hash of role and text, so repeated rows are neighbours. A role is read by its first letter; with
none, or another than s, u and a, a row cannot be kept as it is. Rows with a NULL conv_id are one
conversation. Texts are read whole. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import column, saved
from surveylake.llm.scan import digests, running

BLOCK = 4
SEGMENT = 4096
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States: nothing yet, after system, after user, after assistant; the first and last may end.
FRONT = (2, 2, 3, 2)  # the state after a user or assistant turn that fits
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
NEVER = 1 << 40
BLANKS = " \t\n\x0b\f\r"

# A row's symbol is a letter: role initial (s, u, a, o) by fault (none, truncated, to be deleted).
INITIALS = "suao"
SYMBOLS = "".join(chr(ord("a") + i) for i in range(3 * len(INITIALS)))


def _code(symbol: str) -> int:
    """0 for a row to be deleted, whatever its role; else 1 to 8 by initial and truncation."""
    initial, fault = divmod(SYMBOLS.index(symbol), 3)
    return 0 if fault == 2 else 1 + 2 * initial + fault


CODES = {symbol: _code(symbol) for symbol in SYMBOLS}
N_CODES = 1 + 2 * len(INITIALS)


def _closed(costs: Sequence[int]) -> tuple[int, ...]:
    """Costs at a gap where turns may be inserted."""
    found = list(costs)
    for _ in range(3):
        found = [min(cost, INSERT + found[FRONT[state]]) for state, cost in enumerate(found)]
    return tuple(min(cost, NEVER) for cost in found)


def _stay(code: int, state: int) -> tuple[int | None, int]:
    """The state after keeping a row (None: not possible) and what truncation adds."""
    initial, truncated = divmod(code - 1, 2)
    return KEPT[INITIALS[initial]][state], TRUNCATED * truncated


def _before(code: int, costs: Sequence[int]) -> tuple[int, ...]:
    """Costs in front of a row from those behind it."""
    found = []
    for state in range(4):
        best = DELETE + costs[state]
        if code:
            kept, more = _stay(code, state)
            best = min(best, REROLE + more + costs[FRONT[state]])
            if kept is not None:
                best = min(best, more + costs[kept])
        found.append(best)
    return _closed(found)


def _normal(costs: Sequence[int]) -> tuple[tuple[int, ...], int]:
    least = min(costs)
    return tuple(NEVER if cost >= NEVER else cost - least for cost in costs), least


END = _closed((0, NEVER, NEVER, 0))
UNITS = [tuple(0 if state == end else NEVER for state in range(4)) for end in range(4)]


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]
    number: dict[tuple[int, ...], int]
    row_next: list[list[int]]  # vector, code -> vector
    row_cost: list[list[int]]
    block_next: np.ndarray  # vector, block -> vector
    block_cost: np.ndarray


@lru_cache(maxsize=1)
def tables() -> Tables:
    """Transitions of every normalised cost vector that occurs, over rows and over blocks."""
    vectors = list(dict.fromkeys([END, *UNITS]))
    number = {vector: i for i, vector in enumerate(vectors)}
    row_next, row_cost = [], []
    for vector in vectors:  # grows while it is read
        row_next.append([])
        row_cost.append([])
        for code in range(N_CODES):
            found, cost = _normal(_before(code, vector))
            if found not in number:
                number[found] = len(vectors)
                vectors.append(found)
            row_next[-1].append(number[found])
            row_cost[-1].append(cost)
    one, cost = np.array(row_next), np.array(row_cost)
    block_next, block_cost = one, cost
    for _ in range(BLOCK - 1):  # a row in front of the rows so far
        behind = block_next[:, None, :]
        first = np.arange(N_CODES)[None, :, None]
        block_cost = (block_cost[:, None, :] + cost[behind, first]).reshape(len(vectors), -1)
        block_next = one[behind, first].reshape(len(vectors), -1)
    return Tables(vectors, number, row_next, row_cost, block_next, block_cost)


def _codes(symbols: str) -> list[int]:
    return [CODES[symbol] for symbol in symbols]


def _blocks(codes: list[int]) -> list[int]:
    """Numbers of the whole blocks; what is left behind them is shorter than a block."""
    found = []
    for at in range(0, len(codes) - len(codes) % BLOCK, BLOCK):
        block = 0
        for code in codes[at : at + BLOCK]:
            block = block * N_CODES + code
        found.append(block)
    return found


def _passed(codes: list[int], blocks: list[int], end: Sequence[int]) -> list[tuple[int, int]]:
    """Vector number and minimum in front of the rest and of every block, last block first."""
    known = tables()
    normal, cost = _normal(end)
    vector = known.number[normal]
    for code in reversed(codes[len(blocks) * BLOCK :]):
        cost += known.row_cost[vector][code]
        vector = known.row_next[vector][code]
    found = [(vector, cost)]
    for block in reversed(blocks):
        cost += int(known.block_cost[vector, block])
        vector = int(known.block_next[vector, block])
        found.append((vector, cost))
    return found


def _plus(vector: tuple[int, int]) -> list[int]:
    normal, cost = tables().vectors[vector[0]], vector[1]
    return [NEVER if part >= NEVER else part + cost for part in normal]


def summed(symbols: str) -> dict:
    """A segment's costs from each state in front of it to each behind it, and its illegal neighbours."""
    codes = _codes(symbols)
    blocks = _blocks(codes)
    by_end = [_plus(_passed(codes, blocks, unit)[-1]) for unit in UNITS]
    initials = "".join(INITIALS[SYMBOLS.index(symbol) // 3] for symbol in symbols)
    illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(initials) - 1))
    return {"costs": [by_end[end][state] for state in range(4) for end in range(4)], "illegal": illegal, "edges": initials[0] + initials[-1]}


def folded(segments: list[dict]) -> dict:
    """Costs behind every segment of a conversation, the whole cost and its illegal neighbours."""
    behind, ends = END, []
    for segment in reversed(segments):
        ends.append(list(behind))
        costs = segment["costs"]
        behind = tuple(min(NEVER, *(costs[4 * state + end] + behind[end] for end in range(4))) for state in range(4))
    seams = zip((segment["edges"][1] for segment in segments), (segment["edges"][0] for segment in segments[1:]))
    illegal = sum(segment["illegal"] for segment in segments) + sum(a + b not in ("su", "ua", "au") for a, b in seams)
    return {"ends": ends[::-1], "cost": behind[0], "illegal": illegal}


def traced(symbols: str, end: list[int], first: bool, last: bool) -> list[dict]:
    """From each state in front of a segment: the edits, the new roles (``-``: gone) and the state behind."""
    codes = _codes(symbols)
    blocks, known = _blocks(codes), tables()
    passed = _passed(codes, blocks, end)
    starts = [0] if first else range(4)
    states = {start: start for start in starts}
    audits: dict[int, list[str]] = {start: [] for start in starts}
    roles: dict[int, list[str]] = {start: [] for start in starts}
    for number in range(len(blocks) + 1):
        some = codes[number * BLOCK : (number + 1) * BLOCK]
        # The vectors of the block's gaps, from the one behind it.
        if number < len(blocks):
            gaps = [passed[len(blocks) - number - 1]]
        else:
            normal, cost = _normal(end)
            gaps = [(known.number[normal], cost)]
        for code in reversed(some):
            vector, cost = gaps[-1]
            gaps.append((known.row_next[vector][code], cost + known.row_cost[vector][code]))
        costs = [_plus(gap) for gap in reversed(gaps)]
        for start in starts:
            if passed and _plus(passed[-1])[start] >= NEVER:
                continue  # no repair leads through this state
            state = states[start]
            for i, code in enumerate(some):
                state = _edited(code, state, costs[i], costs[i + 1], audits[start], roles[start])
            states[start] = state
    for start in starts:
        while last and states[start] in (1, 2):
            audits[start].append("I")
            roles[start].append("ua"[states[start] == 2])
            states[start] = FRONT[states[start]]
    found = [{"audit": "", "roles": "", "state": 0} for _ in range(4)]
    for start in starts:
        found[start] = {"audit": "".join(audits[start]), "roles": "".join(roles[start]), "state": states[start]}
    return found


def _edited(code: int, state: int, here: list[int], behind: list[int], audit: list[str], roles: list[str]) -> int:
    """Take the ASCII-least of the cheapest edits up to one row; returns the state behind it."""
    while True:
        cost = here[state]
        if cost == DELETE + behind[state]:
            audit.append("D")
            roles.append("-")
            return state
        if cost == INSERT + here[FRONT[state]]:
            audit.append("I")
            roles.append("a" if state == 2 else "u")
            state = FRONT[state]
            continue
        kept, more = _stay(code, state)
        if kept is not None and cost == more + behind[kept]:
            audit.append("K")
            roles.append("sua"[kept - 1])
            return kept
        audit.append("R")
        roles.append("a" if state == 2 else "u")
        return FRONT[state]


def chosen(states: list[list[int]]) -> list[int]:
    """The state in front of every segment, from the states behind each by the state in front."""
    found, state = [], 0
    for behind in states:
        found.append(state)
        state = behind[state]
    return found


def placed(audit: str, roles: str) -> list[dict]:
    """Every edit that leaves a turn: its number, the row (from 1) that it stays at and the new role."""
    found, row = [], 0
    for number, (edit, role) in enumerate(zip(audit, roles)):
        row += edit != "I"
        if edit != "D":
            found.append({"number": number, "row": row if edit != "I" else None, "edit": edit, "role": role})
    return found


def _by_row(function: Callable, kind: pa.DataType, spark_type: str, *columns: Column) -> Column:
    def run(*arrays: pa.Array) -> pa.Array:
        return pa.array([function(*row) for row in zip(*(array.to_pylist() for array in arrays))], kind)

    return F.arrow_udf(run, spark_type, F.ArrowUDFType.SCALAR)(*columns)


_LONGS = pa.list_(pa.int64())
_SUMMED = pa.struct([("costs", _LONGS), ("illegal", pa.int64()), ("edges", pa.string())])
_FOLDED = pa.struct([("ends", pa.list_(_LONGS)), ("cost", pa.int64()), ("illegal", pa.int64())])
_TRACED = pa.list_(pa.struct([("audit", pa.string()), ("roles", pa.string()), ("state", pa.int64())]))
_PLACED = pa.list_(pa.struct([("number", pa.int64()), ("row", pa.int64()), ("edit", pa.string()), ("role", pa.string())]))


class Repaired(NamedTuple):
    summary: DataFrame  # conv, gaps, blank, duplicate, truncated, illegal, cost, audit
    rows: DataFrame  # conv, segment, number, edit, role, text: the repaired turns in (segment, number) order


def conv_key(conv_id: str = "conv_id") -> Column:
    """A text that names a conversation: its id, or one space where that is NULL."""
    return F.coalesce(column(conv_id).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv, turn, role, text`` with one of five faults at places that a checksum of id and turn picks."""
    conv = conv_key()
    which = F.crc32(F.concat(conv, F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (
        conversations.select(conv.alias("conv"), "turn", role.alias("role"), text.alias("text"), which.alias("which"))
        .where("which != 0")
        .select(
            "conv", "turn",
            F.when(F.col("which") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("which") == 1, "").when(F.col("which") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("which") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        )
        .drop("copy")
    )


def repair(rows: DataFrame, segment: int = SEGMENT) -> Repaired:
    """Faults and cheapest repair of conversations given as ``conv`` (never NULL), ``turn, role, text``."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    whole = saved(rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.monotonically_increasing_id().alias("row_id")), "repair-rows")
    ended = F.rtrim("text", F.lit(BLANKS))
    content = F.unhex(F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    initial = F.substring("role", 1, 1)
    slim = whole.select(
        "conv", "turn", "row_id", content.alias("content"),
        F.when(initial.isin(*"sua"), initial).otherwise("o").alias("initial"),
        (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(*".!?")).alias("open"),
    )
    numbered = running(slim, ["conv"], ["turn", "content", "row_id"], {"place": F.lit(1)}, label="repair-places")
    seen = running(numbered, ["conv", "content"], ["place"], {"nth": F.lit(1)}, label="repair-repeats")
    fault = F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate").when(F.col("open"), "truncated")
    state = F.when(fault == "truncated", 1).when(fault.isNotNull(), 2).otherwise(0)
    symbol = F.substring(F.lit(SYMBOLS), (F.position(F.col("initial"), F.lit(INITIALS)) - 1) * 3 + state + 1, F.lit(1))
    marked = saved(seen.select("conv", "turn", "row_id", "place", fault.alias("fault"), symbol.alias("symbol")), "repair-marked")

    def faults(kind: str) -> Column:
        return F.sum(kind).alias(kind)

    by_turn = marked.groupBy("conv", "turn").agg(*(F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")))
    turn = F.col("turn").cast("decimal(20)")
    gaps = F.coalesce((F.max(turn) - F.min(turn) + 1 - F.count("turn")).cast("bigint"), F.lit(0).cast("bigint"))
    counts = by_turn.groupBy("conv").agg(gaps.alias("gaps"), faults("blank"), faults("duplicate"), faults("truncated"))

    in_order = F.array_sort(F.collect_list(F.struct("place", "symbol", "row_id")))
    segments = marked.groupBy("conv", F.floor((F.col("place") - 1) / segment).alias("segment")).agg(in_order.alias("items"))
    segments = saved(
        segments.select("conv", "segment", F.array_join("items.symbol", "").alias("symbols"), F.col("items.row_id").alias("row_ids")), "repair-segments"
    )
    sums = segments.select("conv", "segment", _by_row(summed, _SUMMED, "costs array<bigint>, illegal bigint, edges string", F.col("symbols")).alias("sums"))
    lists = sums.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("segment", "sums"))).alias("lists"))
    fold = _by_row(folded, _FOLDED, "ends array<array<bigint>>, cost bigint, illegal bigint", F.col("lists.sums"))
    folds = saved(lists.select("conv", fold.alias("fold")), "repair-folds")
    ends = folds.select("conv", F.posexplode("fold.ends").alias("segment", "end"), (F.size("fold.ends") - 1).alias("final"))
    trace = _by_row(
        traced, _TRACED, "array<struct<audit:string,roles:string,state:bigint>>",
        F.col("symbols"), F.col("end"), F.col("segment") == 0, F.col("segment") == F.col("final"),
    )
    traces = saved(segments.join(ends, ["conv", "segment"]).select("conv", "segment", "row_ids", trace.alias("trace")), "repair-traces")
    states = traces.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("segment", F.col("trace.state").alias("states")))).alias("lists"))
    fronts = states.select("conv", F.posexplode(_by_row(chosen, _LONGS, "array<bigint>", F.col("lists.states"))).alias("segment", "front"))
    picked = F.element_at("trace", F.col("front").cast("int") + 1)
    edits = saved(traces.join(fronts, ["conv", "segment"]).select("conv", "segment", "row_ids", picked["audit"].alias("audit"), picked["roles"].alias("roles")), "repair-edits")

    audits = edits.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("segment", "audit"))).alias("lists"))
    summary = (
        counts.join(folds.select("conv", "fold.illegal", "fold.cost"), "conv")
        .join(audits.select("conv", F.array_join("lists.audit", "").alias("audit")), "conv")
        .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    )
    places = _by_row(placed, _PLACED, "array<struct<number:bigint,row:bigint,edit:string,role:string>>", F.col("audit"), F.col("roles"))
    kept = edits.select("conv", "segment", "row_ids", F.explode(places).alias("edit")).select(
        "conv", "segment", "edit.number", "edit.edit", "edit.role", F.get("row_ids", (F.col("edit.row") - 1).cast("int")).alias("row_id")
    )
    new_role = F.when(F.col("edit") == "K", F.col("old_role")).when(F.col("kept.role") == "a", "assistant").otherwise("user")
    texts = whole.select("row_id", F.col("role").alias("old_role"), "text")
    repaired = kept.alias("kept").join(texts, "row_id", "left").select(
        "conv", "segment", "number", "edit", new_role.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return Repaired(summary, repaired)


def report(conversations: DataFrame, rows: DataFrame, conv_id: str = "conv_id", segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation of ``conversations``: faults, edits and digest of what ``rows`` become."""
    found = repair(rows, segment)
    lines = found.rows.select("conv", "segment", "number", F.concat("role", F.lit(":"), "text").alias("line"))
    sums = digests(lines, "conv", ["segment", "number"], "line", "\n", "repaired_sha256")
    every = conversations.groupBy(column(conv_id)).agg(F.first(conv_key(conv_id)).alias("conv"))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    numbers = [F.coalesce(name, F.lit(0)).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    joined = every.join(found.summary, "conv", "left").join(sums, "conv", "left")
    return joined.select(column(conv_id), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
