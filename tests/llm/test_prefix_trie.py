"""The prefix trie against brute force over all prefixes, and list ranking against walking."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surveylake.llm import prefix_trie, scan
from surveylake.llm.queries import op11_conversation_prefix_trie
from tests.oracle import connect, differences

SCHEMA = "conv_id long, turn long, role string, text string"


def shared_turns(conv_id):
    return zlib.crc32(str(conv_id).encode()) % 6


def nodes_of(rows):
    """All prefixes of all rebuilt conversations; rows of one turn number must be equal."""
    own = collections.defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(found, key=lambda x: x[0])] for c, found in own.items()}
    rebuilt = {c: tuple(own.get(c - c % 100, [])[: shared_turns(c)] + own[c][shared_turns(c) :]) for c in own}
    members = collections.defaultdict(list)
    for c, found in rebuilt.items():
        for depth in range(len(found) + 1):
            members[found[:depth]].append(c)
    children = collections.Counter(path[:-1] for path in members if path)
    leaves, saving = collections.Counter(), collections.Counter()
    for path, found in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saving[path[:depth]] += (len(found) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (
            min(found), len(path), min(members[path[:-1]]) if path else -1, len(found), children[path], leaves[path], saving[path],
            hashlib.sha256(",".join(str(c) for c in sorted(found) if rebuilt[c] == path).encode()).hexdigest(),
        )
        for path, found in members.items()
    )


def built(spark, rows, walked, schema=SCHEMA):
    conv_id = F.col("conv_id")
    own = prefix_trie.turns(spark.createDataFrame(rows, schema))
    shared = F.crc32(conv_id.cast("string")) % 6
    found = prefix_trie.trie(*prefix_trie.restarted(own, shared, conv_id - conv_id % 100, most=5), walked=walked)
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in found.collect())


def test_nodes_match_all_prefixes(spark):
    rng = random.Random(2)
    rows = []
    for conv_id in [*range(0, 8), *range(100, 104), *range(205, 212), 999_901]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv_id, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "é😀", "", None])))
    rows += [(205, None, "system", "s"), (206, 3, "user", "x"), (206, 3, "user", "x"), (None, 0, "user", "lost")]
    rows = [row for i, row in enumerate(rows) if row[:2] != (206, 3) or row[2:] == ("user", "x")]
    rows += [(212, turn, "user", "tail") for turn in range(120)]  # a deep path
    rows += [(300 + i, 0, "user", "alike") for i in range(1, 40)]  # a wide node
    assert built(spark, rows, walked=20) == nodes_of(rows)


def test_turnless_conversations_end_at_the_root(spark):
    conv_id = next(c for c in range(1, 99) if shared_turns(c) >= 2)
    rows = [(conv_id, 0, "user", "gone")]
    empty = hashlib.sha256(str(conv_id).encode()).hexdigest()
    assert built(spark, rows, 10) == [(conv_id, 0, -1, 1, 0, 1, 0, empty)] == nodes_of(rows)


def test_turns_of_one_number_and_repeated_rows_have_one_order(spark):
    rows = [(0, 1, "user", text) for text in "abcab"] + [(0, None, None, None)] * 2
    runs = [built(spark, random.Random(n).sample(rows, len(rows)), 10) for n in range(3)]
    assert runs[0] == runs[1] == runs[2] and len(runs[0]) == 8


def test_empty_table_and_other_columns(spark):
    assert built(spark, [], 10) == []
    rows = [(1, 0, "user", "a", 5, "k", "p"), (2, 0, "user", "a", 6, None, "q")]
    wide = built(spark, rows, 10, SCHEMA + ", place int, key string, `a.b` string")
    assert wide == nodes_of([row[:4] for row in rows])


def test_long_texts(spark):
    rows = [(c, 0, "user", "word " * 100_000 + "x" * (c // 300)) for c in (3, 300, 301)]
    assert built(spark, rows, 10) == nodes_of(rows)


@pytest.mark.parametrize("n", [1, 2, 50, 3000])
def test_list_ranking(spark, n):
    order = random.Random(n).sample(range(n), n)
    arcs = [(a, b) for a, b in zip(order, [*order[1:], None])]
    found = prefix_trie.list_rank(spark.createDataFrame(arcs, "arc long, next long"), walked=30).collect()
    assert {r.arc: r.position for r in found} == {a: i for i, a in enumerate(order)} and len(found) == n


def test_running_sums_over_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "a", "a", "b", "c"]), i, rng.randint(-5, 5)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g string, `o.o` int, part int").repartition(7)
    found = scan.running(frame, ["g"], ["o.o"], sums={"in_group": "part"}, overall={"everywhere": F.lit(1)}).collect()
    sums, place = collections.Counter(), 0
    want = {}
    for g, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        sums[g] += v
        place += 1
        want[g, o] = (v, sums[g], place)
    assert {(r.g, r["o.o"]): (r.part, r.in_group, r.everywhere) for r in found} == want


def test_digests_of_ordered_texts(spark, monkeypatch):
    monkeypatch.setattr(scan, "CHUNK_BYTES", 10)
    rows = [(k, i, f"t{i}é" * (i % 4)) for k in ("a", "b", "") for i in range(200)] + [("c", 0, "")]
    found = scan.digests(spark.createDataFrame(rows, "k string, i int, t string"), "k", ["i"], "t", "\n", "sha").collect()
    want = {key: hashlib.sha256("\n".join(t for k, _, t in rows if k == key).encode()).hexdigest() for key in ("a", "b", "", "c")}
    assert {r.k: r.sha for r in found} == want and len(found) == 4


def test_the_query_matches_its_sql(spark):
    problems, n = differences(op11_conversation_prefix_trie(spark, "/root/testdata/sf0.001"), connect("/root/testdata/sf0.001"), prefix_trie.TRIE_SQL)
    assert problems == [] and n > 0
