"""Repair of conversations against a plain search over all edits."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest

from surveylake.llm import structure_repair as repair
from surveylake.llm.queries import op12_structure_repair

SCHEMA = "conv_id long, turn long, role string, text string"
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, found = set(), []
    for role, text in rows:
        inner = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        if not inner:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append(None if inner[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows):
    """Least (cost, edits) with the repaired rows, by trying every edit at every place."""
    faults = faults_of(rows)

    @functools.lru_cache(None)
    def best(i, state, inserted):
        options = []
        if i == len(rows) and state in (0, 3):
            options.append((0, "", ()))
        if inserted < 3:
            for initial, role in NAMES.items():
                if (state, initial) in MOVES:
                    cost, audit, out = best(i, MOVES[state, initial], inserted + 1)
                    options.append((cost + 3, "I" + audit, ((role, ""), *out)))
        if i < len(rows):
            cost, audit, out = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, out))
            if faults[i] in (None, "truncated"):
                more = 3 * (faults[i] == "truncated")
                for role, edit, price in ((rows[i][0], "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if (state, role[:1]) in MOVES:
                        cost, audit, out = best(i + 1, MOVES[state, role[:1]], 0)
                        options.append((cost + price + more, edit + audit, ((role, rows[i][1]), *out)))
        return min(options) if options else (10**9, "~", ())

    return best(0, 0, 0)


def after_damage(rows):
    """Conversation -> its rows after damage in order; rows of one turn must be equal."""
    found = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        which = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        kept = found[conv_id]
        if which == 0:
            continue
        text = "" if which == 1 else re.sub("[.!?]", "", text) if which == 2 else text
        role = "user" if which == 4 else role
        kept.extend([(turn, role, text)] * (2 if which == 3 else 1))
    return {conv: sorted(kept, key=lambda r: (r[0] is not None, r[0] or 0)) for conv, kept in found.items()}


def expected(rows):
    out = []
    for conv_id, kept in after_damage(rows).items():
        turns = {turn for turn, _, _ in kept if turn is not None}
        plain = [(role, text) for _, role, text in kept]
        faults = faults_of(plain)
        initials = [role[:1] for role, _ in plain]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, repaired = cheapest(tuple(plain))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in repaired))
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in repaired).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv_id, gaps, *(faults.count(kind) for kind in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=repr)


def reported(spark, rows, segment, schema=SCHEMA):
    conversations = spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in repair.report(conversations, repair.damaged(conversations), segment=segment).collect()), key=repr)


def rows_of(rng, conv_id, n):
    roles = ["user", "assistant", "system", "tool", None]
    texts = ["a.", "b!", "cut", " ", None, "c?\n", "", "d. \t", "e ", "same.", "same."]
    return [(conv_id, turn * rng.choice((1, 1, 2)), rng.choices(roles, (8, 8, 2, 1, 1))[0], rng.choice(texts)) for turn in range(0, 2 * n, 2)]


@pytest.mark.parametrize("segment", [4096, 3])
def test_reports_match_the_plain_search(spark, segment):
    rng = random.Random(segment)
    rows = []
    for conv_id in range(60):
        # Rows of one turn number would need the order of their hashes: one row each.
        rows += list({(r[0], r[1]): r for r in rows_of(rng, conv_id, rng.randint(1, 14))}.values())
    rows += [(70, None, "user", "a."), (70, None, "user", "a."), (None, 0, "user", "x."), (None, 1, "assistant", "y.")]
    rows += [(71, turn, ("user", "assistant")[turn % 2], f"long {turn}.") for turn in range(150)]
    assert reported(spark, rows, segment) == expected(rows)


def test_blocks_segments_and_rows_agree():
    rng = random.Random(3)
    for _ in range(400):
        symbols = "".join(rng.choices(repair.SYMBOLS, k=rng.randint(1, 23)))
        costs = repair.END
        for symbol in reversed(symbols):
            costs = repair._before(repair.CODES[symbol], costs)
        one = repair.folded([repair.summed(symbols)])
        cuts = sorted({0, len(symbols), *rng.choices(range(len(symbols) + 1), k=3)})
        parts = [symbols[a:b] for a, b in itertools.pairwise(cuts)]
        many = repair.folded([repair.summed(part) for part in parts])
        assert costs[0] == one["cost"] == many["cost"] and one["illegal"] == many["illegal"]
        whole = repair.traced(symbols, one["ends"][0], True, True)[0]["audit"]
        traces = [repair.traced(part, end, i == 0, i == len(parts) - 1) for i, (part, end) in enumerate(zip(parts, many["ends"]))]
        fronts = repair.chosen([[state["state"] for state in trace] for trace in traces])
        assert whole == "".join(trace[front]["audit"] for trace, front in zip(traces, fronts))


def test_tables_are_small_and_complete():
    tables = repair.tables()
    assert len(tables.vectors) < 200 and tables.block_next.shape == (len(tables.vectors), repair.N_CODES**repair.BLOCK)


def test_a_conversation_without_rows_after_damage(spark):
    conv_id = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert reported(spark, [(conv_id, 0, "user", "x.")], 10) == [(conv_id, 0, 0, 0, 0, 0, 0, "", empty)]


def test_empty_table_ties_and_other_columns(spark):
    assert reported(spark, [], 10) == []
    rows = [(5, 1, role, text) for role in ("user", "assistant") for text in ("a.", "b.", "b.")]
    runs = [reported(spark, random.Random(n).sample(rows, len(rows)), 10) for n in range(3)]
    assert runs[0] == runs[1] == runs[2]
    rows = [(c, t, ("user", "assistant")[t % 2], f"w{t}.") for c in range(4) for t in range(5)]
    wide = [(*row, "x", 1, 2) for row in rows]
    assert reported(spark, wide, 10, SCHEMA + ", conv string, row_id int, `a.b` int") == expected(rows)


def test_long_texts(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], "word " * 60_000 + f"{t}.") for c in range(2) for t in range(4)]
    assert reported(spark, rows, 4096) == expected(rows)


def test_the_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op12_structure_repair(spark, sf_dir).collect()), key=repr) == expected(rows)
