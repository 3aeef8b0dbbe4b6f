"""Chains against all-pairs dynamic programming; passages against planted ones."""

import random

import numpy as np

from surveylake.llm import chaining
from surveylake.llm.words import shingles, word_hashes


def test_word_hashes_split_and_tell_words_apart():
    texts = ["a b", "", " \n", "ab  é\tb", "b a"]
    hashes, first, start, end = word_hashes(texts)
    assert first.tolist() == [0, 2, 2, 2, 5, 7]
    data = [t.encode() for t in texts]
    words = [data[np.searchsorted(first, i, side="right") - 1][start[i] : end[i]] for i in range(len(hashes))]
    assert words == [b"a", b"b", b"ab", "é".encode(), b"b", b"b", b"a"]
    assert len(set(hashes.tolist())) == 4
    long = "x" * 3_000_000
    both = word_hashes([f"{long} y", f"y {long}"])[0]
    assert both[0] == both[3] and both[1] == both[2] != both[0]
    assert len(shingles(both, 5)) == 1 and len(shingles(both[:0], 5)) == 0


def test_shared_words_share_a_seed():
    rng = np.random.default_rng(1)
    for _ in range(50):
        common = rng.integers(0, 2**60, chaining.K + chaining.PICK - 1).astype(np.uint64)
        texts = [np.concatenate([rng.integers(0, 2**60, rng.integers(0, 40)).astype(np.uint64), common, rng.integers(0, 2**60, 9).astype(np.uint64)]) for _ in range(2)]
        a, b = (set(chaining.seeds(t)[0].tolist()) for t in texts)
        assert a & b


def test_chains_are_the_best_ones():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = rng.integers(1, 30)
        a, b = rng.integers(0, 60, n), rng.integers(0, 60, n)
        best, order = np.ones(n), np.lexsort((a, b))
        for x, i in enumerate(order):
            for j in order[:x]:
                if a[j] < a[i] and b[j] < b[i]:
                    best[i] = max(best[i], 1 + best[j] - chaining.GAP_COST * (a[i] - a[j] + b[i] - b[j]))
        found = chaining.chains(a, b)
        first = found[0]
        value = 1 + sum(1 - chaining.GAP_COST * (a[v] - a[u] + b[v] - b[u]) for u, v in zip(first[:-1], first[1:]))
        assert abs(value - best.max()) < 1e-9
        assert sorted(np.concatenate(found).tolist()) == list(range(n))
        assert all((np.diff(a[c]) > 0).all() and (np.diff(b[c]) > 0).all() for c in found)


def test_planted_passages(documents, words):
    rng = random.Random(4)
    passage, short, common = words(70), words(40), words(55)
    fuzzy = passage[:20] + ["other"] + passage[21:45] + passage[47:]
    texts = [words(rng.randint(60, 300)) for _ in range(60)]
    spots = {}
    for i, inserted in [(3, passage), (8, passage), (20, fuzzy), (5, short), (9, short), *((n, common) for n in range(25, 60))]:
        at = rng.randint(0, len(texts[i]))
        texts[i][at:at] = inserted
        spots[i] = (at, at + len(inserted))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(70, None), (71, ""), (72, "a b c")]
    found = chaining.passages(documents(rows)).collect()
    pairs = {(r.doc_id, r.partner_id) for r in found}
    assert len({frozenset(p) for p in pairs}) == len(pairs) == len(found)
    groups = [{3, 8, 20}, set(range(25, 60))]
    for group in groups:  # linked as a whole, by far fewer links than pairs
        own = [p for p in pairs if p[0] in group]
        assert all(p[1] in group for p in own) and len(group) - 1 <= len(own) <= 3 * len(group)
        reached = {min(group)}
        for _ in group:
            reached |= {x for p in own if reached & set(p) for x in p}
        assert reached == group
    assert {x for p in pairs for x in p} == groups[0] | groups[1]
    for r in found:
        for doc, start, end in ((r.doc_id, r.start, r.end), (r.partner_id, r.partner_start, r.partner_end)):
            low, high = spots[doc]
            assert abs(start - low) <= 2 and abs(end - high) <= 2
        assert r.n_equal >= 50


def test_copies_and_repeated_rows(documents, words):
    text, other = " ".join(words(90)), " ".join(words(90))
    rows = [(1, text), (2, text), (2, text), (3, other), (3, other), (None, text)]
    docs = documents([(*row, "en", "a", 5) for row in rows], ", seeds int")
    found = {(r.doc_id, r.partner_id, r.n_equal) for r in chaining.passages(docs).collect()}
    assert {frozenset(x[:2]) for x in found} >= {frozenset({1, 2})} and all(n == 90 for *_, n in found)
    assert len(found) == 2 and not any(3 in x[:2] for x in found)


def test_empty_table(documents):
    assert chaining.passages(documents([])).count() == 0


def test_rows_of_a_document_may_span_batches():
    import pandas as pd

    rows = [(1, 2, i * 7, i * 7) for i in range(50)] + [(1, 3, 5, 9), (2, 3, 1, 11), (2, 3, 8, 18), (2, 3, 30, 40), (2, 4, 1, 1)]
    frame = pd.DataFrame(rows, columns=["anchor", "uid", "anchor_place", "place"])
    whole = pd.concat(chaining._chained(iter([frame])))
    assert set(whole["uid"]) == {2, 3}
    for size in (1, 3, 20, 51):
        parts = [frame[i : i + size] for i in range(0, len(frame), size)]
        out = pd.concat(chaining._chained(iter(parts)))
        assert list(out["uid"]) == list(whole["uid"]) and [x.tolist() for x in out["places"]] == [x.tolist() for x in whole["places"]]


def test_links_count_only_along_a_stretch_of_shared_seeds():
    anchor, a = np.array([1, 1, 1, 2, 1, 3]), np.array([0, 9, 18, 7, 27, 4])
    b = np.array([100, 109, 118, 112, 127, 500])
    found = chaining.document_chains(anchor, a, b)
    assert [(other, links.tolist()) for other, links in found] == [(1, [0, 1, 2, 4])]
    assert chaining.document_chains(anchor[:2], a[:2], b[:2]) == []


def test_a_passage_put_together_from_earlier_fragments(documents, words):
    rng = random.Random(6)
    rows, wanted = [], {}
    for n in range(12):
        passage = words(60)
        for i, part in enumerate((passage[:30], passage[30:], passage, passage)):
            at = rng.randint(20, 40)
            own = words(80)
            own[at:at] = part
            rows.append((10 * n + i, " ".join(own)))
            wanted[10 * n + i] = (at, at + len(part))
    found = chaining.passages(documents(rows)).collect()
    assert {frozenset((r.doc_id, r.partner_id)) for r in found} == {frozenset((10 * n + 2, 10 * n + 3)) for n in range(12)}
    for r in found:
        low, high = wanted[r.doc_id]
        assert abs(r.start - low) <= 2 and abs(r.end - high) <= 2 and r.n_equal >= 60


def test_every_run_of_equal_words_lies_in_a_stretch():
    rng = np.random.default_rng(9)
    for _ in range(300):
        common = rng.integers(0, 2**60, chaining.LEAST).astype(np.uint64)
        at = rng.integers(0, 60, 2)
        x, y = (np.concatenate([rng.integers(0, 2**60, n).astype(np.uint64), common, rng.integers(0, 2**60, 30).astype(np.uint64)]) for n in at)
        (seeds, _), (others, places) = chaining.seeds(x), chaining.seeds(y)
        starts, ends = chaining.stretches(places[np.isin(others, seeds)])
        assert chaining.windows_in(starts, ends, len(y) - chaining.LEAST + 1)[at[1]]


def test_passages_with_changed_words(documents, words):
    rng = random.Random(12)
    for every, least in ((10, 38), (8, 33)):  # of 40 planted passages of 80 words
        rows = []
        for n in range(40):
            passage = [rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(80)]
            changed = [f"x{n}.{i}" if i % every == every - 1 else word for i, word in enumerate(passage)]
            for i, part in enumerate((passage, changed)):
                rows.append((2 * n + i, " ".join(f"{n}.{i}.{j}" for j in range(40)) + " " + " ".join(part) + f" end{n}.{i}"))
        found = chaining.passages(documents(rows)).collect()
        assert all({r.doc_id // 2} == {r.partner_id // 2} for r in found)
        assert len({r.doc_id // 2 for r in found}) >= least


def test_words_round_the_chains_give_the_passages_of_whole_texts(spark, documents, words, monkeypatch):
    rng = random.Random(21)
    rows = [(n, " ".join(words(400))) for n in range(6)]
    long, phrase = words(900), "one phrase of seven words stands here".split()
    for n in range(6, 30):  # a common phrase, parts of one long text, and a text that repeats itself
        own = words(300)
        own[150:150] = phrase if n % 3 else long[20 * n : 20 * n + rng.choice((60, 200, 380))]
        rows.append((n, " ".join(own)))
    rows += [(30, " ".join(words(9) * 40)), (31, rows[-1][1] + " end"), (32, rows[6][1])]
    docs, sent, cut_out = documents(rows), [], chaining._cut_out
    monkeypatch.setattr(chaining, "_cut_out", lambda margin: (sent.append(margin), cut_out(margin))[1])
    near = {tuple(r) for r in chaining.passages(docs).collect()}
    assert chaining.MARGIN in sent and None in sent
    monkeypatch.setattr(chaining, "_cut_out", lambda margin: cut_out(None))
    assert near == {tuple(r) for r in chaining.passages(docs).collect()} and len(near) > 8


def test_few_words_are_sent_for_a_link(documents):
    import pyarrow as pa

    wanted = {"anchor": 1, "part": 0, "low": 500, "high": 500, "anchor_places": [3], "places": [500], "sizes": [1]}
    text = " ".join(f"é{i}" for i in range(2000))
    batch = pa.RecordBatch.from_pylist([{"doc_id": 7, "uid": 2, "text": text, "wanted": [wanted, wanted | {"low": 0, "high": 1990}]}])
    found = pa.Table.from_batches(chaining._cut_out(chaining.MARGIN)(iter([batch]))).to_pylist()
    first, last = 500 - chaining.MARGIN, 500 + chaining.K + chaining.MARGIN
    assert [(r["begin"], r["behind"], r["places"]) for r in found] == [(first, True, [500]), (0, False, [500])]
    assert found[0]["text"].split(" ") == [f"é{i}" for i in range(first, last)] and found[1]["text"] == text


def test_the_first_document_of_a_seed_is_found_without_a_sort(documents, words, monkeypatch):
    rng = random.Random(31)
    passage = words(70)
    rows = []
    for n in range(8):  # a passage, and a document that repeats itself
        own = words(90)
        at = rng.randint(0, 80)
        own[at:at] = passage
        rows.append((n, " ".join(own)))
    rows += [(8, " ".join(words(7) * 30)), (9, rows[-1][1])]
    plans, kept = {}, chaining._kept
    monkeypatch.setattr(chaining, "_kept", lambda frame, label: (plans.update({label: frame._jdf.queryExecution().executedPlan().toString()}), kept(frame, label))[1])
    assert chaining.passages(documents(rows)).count()
    assert "HashAggregate" in plans["passage-anchors"] and not [label for label, plan in plans.items() if "SortAggregate" in plan]
    assert plans["passage-chains"].split("MapInArrow")[0].count("Exchange") == 0  # the chains of a pair are put together where they are made


def test_the_first_of_equal_seeds_in_each_text():
    rng = np.random.default_rng(3)
    for top in (5, 2**62):
        values, of = rng.integers(0, top, 400), np.sort(rng.integers(0, 9, 400))
        seen, wanted = set(), []
        for pair in zip(of.tolist(), values.tolist()):
            wanted.append(pair not in seen)
            seen.add(pair)
        assert chaining.first_ones(values, of).tolist() == wanted
    import pyarrow as pa

    texts = ["a b c d e f g " * 20, "", "one two", " ".join(f"w{i}" for i in range(60)) + " w1 w2 w3 w4 w5 w6 w7 w8 w9" * 3]
    for text, row in zip(texts, next(chaining._seed_rows(iter([pa.array(texts)]))).to_pylist()):
        values, places = chaining.seeds(word_hashes([text])[0])
        assert sorted(zip(row["seeds"], row["places"])) == sorted(zip(values.view(np.int64).tolist(), places.tolist()))
        first = {seed: place for seed, place in reversed(list(zip(values.view(np.int64).tolist(), places.tolist())))}
        assert dict(zip(row["seeds"][: row["firsts"]], row["places"])) == first and row["firsts"] == len(first)


def test_pairs_hold_the_chains_and_stretches_of_each_document():
    import pandas as pd

    rng = np.random.default_rng(8)
    rows = {(u, a, p, q) for u, a, p, q in rng.integers(0, (9, 5, 70, 70), (900, 4)).tolist()}
    rows |= {(20, 3, 7 * i, 5 * i + 400 * (i > 9)) for i in range(30)}  # in order in both texts, with a gap
    frame = pd.DataFrame(sorted(rows), columns=["uid", "anchor", "anchor_place", "place"])
    found = chaining._pair_rows(frame).to_pylist()
    assert len({(r["uid"], r["anchor"]) for r in found}) == len(found)
    got = {(r["uid"], r["anchor"]): r for r in found}
    for uid, own in frame.groupby("uid"):
        starts, ends = chaining.stretches(own["place"].to_numpy())
        assert ((uid, chaining.STRETCH) in got) == (len(starts) > 0)
        if len(starts):
            assert (got[uid, chaining.STRETCH]["anchor_places"], got[uid, chaining.STRETCH]["places"]) == (starts.tolist(), ends.tolist())
        links = own[own["anchor"] != uid]
        a, b = links["anchor_place"].to_numpy(), links["place"].to_numpy()
        wanted = {}
        for other, chain in chaining.all_chains(links["anchor"].to_numpy(), a, b):
            wanted.setdefault(other, []).append(list(zip(a[chain].tolist(), b[chain].tolist())))
        assert {other for u, other in got if u == uid} - {chaining.STRETCH} == set(wanted)
        for other, chains in wanted.items():
            row = got[uid, other]
            places = list(zip(row["anchor_places"], row["places"]))
            ends = np.cumsum(row["sizes"]).tolist()
            assert [places[low:high] for low, high in zip([0, *ends], ends)] == chains


def test_links_in_order_have_the_scores_of_the_tree():
    rng = np.random.default_rng(5)
    for _ in range(100):
        n = int(rng.integers(1, 40))
        a, b = (np.cumsum(rng.choice([1, 3, 12, 40, 100, 200], n)).tolist() for _ in range(2))
        assert chaining._scores_in_order(a, b) == chaining._scores(a, b)


def test_exact_runs_are_those_of_a_plain_search():
    def equal(x, y):
        return next((n for n, (one, other) in enumerate(zip(x, y)) if one != other), min(len(x), len(y)))

    def nearest(x, y):
        near = [(i + j, i, j) for i in range(chaining.GAP + 1) for j in range(chaining.GAP + 1) if len(x[i : i + 3]) == 3 and x[i : i + 3] == y[j : j + 3]]
        return min(near)[1:] if near else None

    def plain(x, y, links):
        blocks = []
        for i, j in links:
            low, down = (blocks[-1][0] + blocks[-1][2], blocks[-1][1] + blocks[-1][2]) if blocks else (0, 0)
            if i < low or j < down or equal(x[i : i + chaining.K], y[j : j + chaining.K]) < min(chaining.K, len(x) - i, len(y) - j):
                continue
            n = equal(x[low:i][::-1], y[down:j][::-1])
            i, j = i - n, j - n
            u, v, head = i, j, []
            while not blocks and (near := nearest(x[:u][::-1], y[:v][::-1])):
                u, v = u - near[0], v - near[1]
                n = equal(x[:u][::-1], y[:v][::-1])
                u, v = u - n, v - n
                head.insert(0, (u, v, n))
            blocks += head
            near = (0, 0)
            while near:
                i, j = i + near[0], j + near[1]
                n = equal(x[i:], y[j:])
                blocks.append((i, j, n))
                i, j = i + n, j + n
                near = nearest(x[i:], y[j:])
        return blocks

    rng = np.random.default_rng(14)
    for n in range(150):
        x = rng.integers(0, 2**60 if n % 3 else 4, rng.integers(6, 150)).astype(np.uint64)
        kept = x[rng.random(len(x)) > 0.06]
        y = np.concatenate([rng.integers(0, 9, rng.integers(0, 12)).astype(np.uint64), np.insert(kept, rng.integers(0, len(kept) + 1, 5), np.uint64(7))])
        links = sorted(zip(rng.integers(0, len(x), 12).tolist(), rng.integers(0, len(y), 12).tolist()))
        links += [(i, j) for i in range(len(x) - 5) for j in range(len(y) - 5) if (x[i : i + 6] == y[j : j + 6]).all()]
        links = [links[chain_link] for chain_link in chaining.chains(*map(np.array, zip(*sorted(set(links)))))[0].tolist()] if n % 2 else sorted(set(links))
        wanted = plain(x.tolist(), y.tolist(), links)
        assert chaining.exact_runs(x, y, links) == wanted
        assert chaining.exact_runs(x, y, links, chaining.threes(x).tolist(), chaining.threes(y).tolist()) == wanted


def test_places_of_words_without_their_hashes():
    texts = ["a b c", "", " \n", "ab  é\tb", "b" * 3_000_000 + " c"]
    assert all((x == y).all() for x, y in zip(word_hashes(texts)[1:], word_hashes(texts, hashed=False)[1:]))
