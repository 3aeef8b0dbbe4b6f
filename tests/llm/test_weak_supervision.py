"""Statistics against brute force; estimated accuracies against planted ones."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from surveylake.llm import queries

from surveylake.llm import weak_supervision as weak


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(inside),
    )


def test_base_statistics():
    rng = random.Random(9)
    texts = ["", " \n\t", "a", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "é\x1cb\u00a0c \x0b d#|", "x\r\nx\r\n\n\nx"]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += ["".join(rng.choice("ab \n\t\v\f\r#é😀") for _ in range(rng.randint(1, 80))) for _ in range(300)]
    for text in texts:
        assert weak.statistics(text)[:5] == brute(text), text


def test_letters_and_lines():
    found = dict(zip(weak.NAMES, weak.statistics("Ab é1.\nno end\n\n ok!  ")))
    assert (found["n_letters"], found["n_upper"], found["n_lines"], found["n_ended_lines"], found["n_exclaimed"]) == (10, 1, 3, 2, 1)


def test_accuracies_are_recovered():
    rng = np.random.default_rng(0)
    good = rng.random(40_000) < 0.7
    accuracy = np.array([0.9, 0.8, 0.75, 0.85, 0.6])
    votes = np.where(rng.random((len(good), 5)) < accuracy, 1, -1) * np.where(good, 1, -1)[:, None]
    votes[rng.random(votes.shape) < 0.3] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = weak.estimate(patterns, counts.astype(float))
    assert abs(found.prior - 0.7) < 0.02
    right = found.good[:, 2] / (found.good[:, 0] + found.good[:, 2])
    assert np.abs(right - accuracy).max() < 0.03


def test_posterior_matches_the_estimate(spark, documents, words):
    rows = [(i, " ".join(words(60)) + ".") for i in range(60)]
    rows += [(100 + i, " ".join(w + "%%%" for w in words(60)).upper()) for i in range(15)] + [(200, None), (201, "")]
    found = weak.measured(documents(rows)).cache()
    rules = weak.default_rules()
    known = weak.fit(found.where(~weak.base_failed()), rules)
    out = {r.doc_id: r.p for r in found.select("doc_id", weak.posterior(rules, known).alias("p")).collect()}
    assert all(out[i] > 0.5 for i in range(60)) and all(out[100 + i] < 0.5 for i in range(15))
    failed = {r.doc_id for r in found.where(weak.base_failed()).collect()}
    assert failed == {200, 201}
    votes = {r.doc_id: r.v for r in found.select("doc_id", F.array(*[rule.vote() for rule in rules]).alias("v")).collect()}
    odds = np.log(known.prior / (1 - known.prior)) + sum(np.log(known.good[k, v + 1] / known.bad[k, v + 1]) for k, v in enumerate(votes[0]))
    assert abs(out[0] - 1 / (1 + np.exp(-odds))) < 1e-9
    found.unpersist()


def test_empty_table_and_clashing_columns(documents):
    empty = weak.measured(documents([]))
    assert weak.posterior(weak.default_rules(), weak.fit(empty, weak.default_rules())) is not None and empty.count() == 0
    docs = documents([(1, "a b", "en", "a", 5, "x")], ", n_words int, found string")
    row = weak.measured(docs).first()
    assert row.n_words == 2 and row.found == "x"


def test_verdicts_agree_with_labels(spark):
    """Held-out check: the labels are never read by the method."""
    found = queries.op7_quality_rules(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.where("not base_failed").select("doc_id", "kept").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in rows.collect()}
    assert share[1] > 0.99 and share[0] < 0.6
