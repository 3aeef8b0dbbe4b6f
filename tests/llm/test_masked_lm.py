"""Gradients against finite differences; a trained network tells text from shuffled text."""

import random
import time

import numpy as np
import pytest

from surveylake.llm import masked_lm as lm


def test_gradient_is_that_of_the_mean_log_probability(monkeypatch):
    rng = np.random.default_rng(0)
    network = lm.Network.start()
    around, target = rng.integers(0, lm.BUCKETS, (64, 4)), rng.integers(0, lm.BUCKETS, 64)
    monkeypatch.setattr(lm, "RATE", 1.0)
    stepped = lm.Network(network.flat.copy())
    squares = lm.Network(np.full(lm._SIZE, 1e12, dtype=np.float32))  # makes the step the plain gradient over 1e6
    stepped.learn(around, target, squares)
    gradient = (network.flat - stepped.flat).astype(np.float64) * 1e6
    direction = gradient / np.linalg.norm(gradient)
    step = 0.05
    ahead = lm.Network((network.flat + step * direction).astype(np.float32)).log_probability(around, target).mean()
    behind = lm.Network((network.flat - step * direction).astype(np.float32)).log_probability(around, target).mean()
    assert (behind - ahead) / (2 * step) == pytest.approx(np.linalg.norm(gradient), rel=0.1)


def test_probabilities_of_all_tokens_add_up_to_one():
    network = lm.Network.start()
    around = np.tile([[1, 2, 3, lm.BUCKETS]], (lm.BUCKETS, 1))
    assert np.exp(network.log_probability(around, np.arange(lm.BUCKETS))).sum() == pytest.approx(1, abs=1e-4)


def test_scores_are_sums_over_all_tokens_whatever_the_chunks(monkeypatch, words):
    texts = [" ".join(words(n)) for n in (1, 2, 3, 50, 400)] + [None, "", "a"]
    network = lm.Network.start()
    want = lm.score(texts, network)
    monkeypatch.setattr(lm, "CHUNK_CHARS", 10)
    monkeypatch.setattr(lm, "SCORED", 7)
    got = lm.score(texts, network)
    assert got[0].tolist() == want[0].tolist() == [1, 2, 3, 50, 400, 0, 0, 1]
    assert np.allclose(got[1], want[1], rtol=1e-4) and got[1][5] == 0


def sentences(seed, n):
    rng = random.Random(seed)
    names, verbs = [f"n{i}" for i in range(12)], [f"v{i}" for i in range(12)]
    out = []
    for _ in range(n):
        k = rng.randrange(12)
        out.append(f"the {names[k]} will {verbs[k]} a {names[(k + 1) % 12]} .")
    return " ".join(out)


def test_trained_weights_prefer_text_to_shuffled_text(spark, documents):
    docs = documents([(i, sentences(i, 60)) for i in range(300)] + [(900, None), (901, "")]).repartition(4)
    network = lm.fit(docs)
    held = [sentences(10_000 + i, 40) for i in range(20)]
    mixed = [" ".join(random.Random(1).sample(t.split(), len(t.split()))) for t in held]
    n, good = lm.score(held, network)
    _, bad = lm.score(mixed, network)
    _, before = lm.score(held, lm.Network.start())
    assert good.sum() > 0.6 * before.sum() and (good > bad + 0.3 * n).all()
    rows = {r.doc_id: r for r in lm.scored(docs, network).collect()}
    assert rows[900].n_tokens == rows[901].n_tokens == 0 and rows[900].log_probability == 0 and rows[901].mean_log_probability is None
    assert rows[5].mean_log_probability == pytest.approx(lm.score([sentences(5, 60)], network)[1][0] / rows[5].n_tokens, rel=1e-4)


def test_empty_table_and_clashing_columns(documents):
    assert lm.scored(documents([]), lm.fit(documents([]))).count() == 0
    docs = documents([(1, "a b", "en", "a", 3, 4)], ", n_tokens int, found int")
    row = lm.scored(docs, lm.Network.start()).first()
    assert row.n_tokens == 2 and row.found == 4


def test_every_token_is_learned_once(words):
    texts = [" ".join(words(n)) for n in (1, 2, 7, 300)] + [None, ""]
    assert sum(lm.train(iter([texts]), lm.Network.start(), turn, lm.ROUNDS) for turn in range(lm.ROUNDS)) == 310


def test_words_of_one_bucket_share_its_probability(documents):
    rng = random.Random(3)
    names = [f"w{rng.randrange(10**9)}" for _ in range(20_000)]
    buckets = {}
    for name in names:
        buckets.setdefault(int(lm.word_hashes([name])[0][0]) % lm.BUCKETS, []).append(name)
    often, rare = next(b for b in buckets.values() if len(b) > 1)[:2]
    docs = documents([(1, f"{often} " * 90), (2, f"{often.upper()} {rare}"), (2, f"{often.upper()} {rare}"), (3, rare * 2), (4, None), (5, "")])
    network = lm.Network.start()
    plain = {r.doc_id: r for r in lm.scored(docs, network).collect()}
    rows = lm.scored_words(docs, network).collect()
    found = {r.doc_id: r for r in rows}
    assert len(rows) == 6 and found[4].log_probability == 0 and found[5].mean_log_probability is None
    share = np.log(92 / 94)
    assert found[1].log_probability == pytest.approx(plain[1].log_probability + 90 * share)
    assert found[2].log_probability == pytest.approx(plain[2].log_probability + share + np.log(2 / 94))
    assert found[3].log_probability == plain[3].log_probability
    assert found[2].mean_log_probability == pytest.approx(found[2].log_probability / 2)


def test_chunks_hold_every_token_once(documents, monkeypatch, words):
    texts = [" ".join(words(n)) for n in (1, 2, 30, 400)] + [None, "", "A a B", "A a B"]
    monkeypatch.setattr(lm, "CHUNK_CHARS", 60)
    rows = lm.coded(documents(list(enumerate(texts)))).collect()
    assert len(rows) > 1 and len({r.chunk for r in rows}) == len(rows)
    found = []
    for row in rows:
        assert sum(row.counts) == sum(row.sizes) == len(lm._codes(row.codes, len(row.words))) and len(row["keys"]) == lm.KEY * len(row.sizes)
        found += [row.words[code] for code in lm._codes(row.codes, len(row.words))]
    wanted = np.concatenate([lm.word_hashes([(t or "").lower()])[0].view(np.int64) for t in texts])
    assert sorted(found) == sorted(wanted.tolist())


def test_word_scores_do_not_depend_on_chunks(documents, monkeypatch, words):
    docs = documents([(i, " ".join(words(40)), "en", "a", i, -i, "x") for i in range(30)], ", key int, n_tokens int, log string")
    network = lm.Network.start()
    whole = {r.doc_id: r for r in lm.scored_words(docs, network).collect()}
    monkeypatch.setattr(lm, "CHUNK_CHARS", 300)
    monkeypatch.setattr(lm, "PART_WORDS", 50)
    parts = {r.doc_id: r for r in lm.scored_words(docs.repartition(3), network).collect()}
    assert len(whole) == len(parts) == 30
    for i, row in whole.items():
        assert row.n_tokens == 40 and row.key == i and row.log == "x"
        assert parts[i].log_probability == pytest.approx(row.log_probability, rel=1e-5)


def plain_step(network, around, target):
    """The network after a step as its formulas say, with a row for each token throughout."""
    n, rows, high, low = len(target), np.arange(len(target)), target // lm.HALF, target % lm.HALF
    inputs = network.tokens.take(around.ravel(), axis=0).reshape(n, -1)
    hidden = np.maximum(inputs @ network.inner + network.inner_bias, 0)
    knowing = np.maximum(hidden + network.given.take(high, axis=0), 0)
    errors = []
    for layer, weights, bias, own in ((hidden, network.first, network.first_bias, high), (knowing, network.second, network.second_bias, low)):
        scores = layer @ weights + bias
        scores -= scores.max(axis=1, keepdims=True)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=1, keepdims=True) * np.float32(n)
        scores[rows, own] -= np.float32(1 / n)
        errors.append(scores)
    d_knowing = (errors[1] @ network.second.T) * (knowing > 0)
    d_hidden = (errors[0] @ network.first.T + d_knowing) * (hidden > 0)
    step = lm.Network(np.zeros(lm._SIZE, dtype=np.float32))
    for places, changes, sums in ((around.ravel(), (d_hidden @ network.inner.T).reshape(-1, lm.EMBEDDING), step.tokens), (high, d_knowing, step.given)):
        order = np.argsort(places.astype(np.uint16), kind="stable")
        ordered = places[order]
        starts = np.flatnonzero(np.diff(ordered, prepend=-1))
        sums[ordered[starts]] = np.add.reduceat(changes.take(order, axis=0), starts, axis=0)
    step.inner[:], step.inner_bias[:] = inputs.T @ d_hidden, d_hidden.sum(axis=0)
    step.first[:], step.first_bias[:] = hidden.T @ errors[0], errors[0].sum(axis=0)
    step.second[:], step.second_bias[:] = knowing.T @ errors[1], errors[1].sum(axis=0)
    squares = 1e-6 + step.flat * step.flat
    return lm.Network(network.flat - np.float32(lm.RATE) * step.flat / (np.sqrt(squares) + 1e-8))


def test_a_step_is_that_of_the_plain_formulas_for_less_time():
    rng = np.random.default_rng(1)
    start = lm.Network.start()
    start.flat[:] += rng.normal(0, 0.05, lm._SIZE).astype(np.float32)  # biases too
    words = np.minimum(lm.BUCKETS * rng.random((lm.BATCH, 5)) ** 2, lm.BUCKETS - 1).astype(np.int32)
    around, target = np.ascontiguousarray(words[:, :4]), words[:, 4]
    around[::50, 0] = lm.BUCKETS
    took = {"plain": [], "own": []}
    for _ in range(30):
        own, squares = lm.Network(start.flat.copy()), lm.Network(np.full(lm._SIZE, 1e-6, dtype=np.float32))
        at = time.thread_time()
        own.learn(around, target, squares)
        took["own"].append(time.thread_time() - at)
        at = time.thread_time()
        plain = plain_step(start, around, target)
        took["plain"].append(time.thread_time() - at)
    assert np.allclose(own.flat, plain.flat, rtol=0, atol=1e-5) and not np.allclose(own.flat, start.flat, rtol=0, atol=1e-3)
    assert min(took["own"]) < 0.85 * min(took["plain"])
