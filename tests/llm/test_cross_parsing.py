"""Suffix automata against substring search; languages on held-out text."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from surveylake.llm import cross_parsing as lid


def brute_phrases(text, source):
    """Greedy parse into the longest pieces that occur in ``source``."""
    at = count = 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in source:
            end += 1
        count += 1
        at = max(at + 1, end - 1)
    return count


def test_phrases_are_those_of_a_greedy_parse():
    rng = random.Random(1)
    for _ in range(40):
        source = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 80)))
        texts = ["".join(rng.choice("abcde") for _ in range(rng.randint(0, 60))) for _ in range(20)]
        model = lid.build({"x": [source], "y": ["abcde"]}, 10_000)
        got, sizes = lid.phrases(texts, model)
        assert got[:, 0].tolist() == [brute_phrases(t, source) for t in texts]
        assert sizes.tolist() == [len(t) for t in texts]


def test_runs_of_other_characters_are_one():
    model = lid.build({"x": ["ab cd"]}, 100)
    got, sizes = lid.phrases(["AB -- 12 cd", "", "  "], model)
    assert got.tolist() == [[1], [0], [1]] and sizes.tolist() == [5, 0, 1]


def test_long_texts_are_read_to_their_end():
    model = lid.build({"x": ["ab" * 40], "y": ["cd" * 40]}, 1000)
    total, sizes = lid.phrases(["ab" * 5000 + "cd" * 9000], model)
    assert sizes[0] == 28_000 and total[0, 1] < total[0, 0]
    names, scores = lid.classify(["ab" * 5000 + "cd" * 9000], model)
    assert names == ["y"] and 0.5 < scores[0] <= 1


LANGUAGES = {"aa": "ka ki ku ta ti".split(), "bb": "schr ung heit ver ß".split(), "cc": "ção nho lh ão é".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(LANGUAGES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_held_out_languages(documents):
    rng = random.Random(2)
    rows = [(i, text(rng, lang, rng.randint(5, 60)), lang) for i, lang in enumerate(rng.choice(list(LANGUAGES)) for _ in range(400))]
    wrong = {i for i in range(0, 400, 23)}  # labels may be wrong
    rows = [(i, t, "aa" if i in wrong else lang) for i, t, lang in rows]
    truth = {i: next(l for l in LANGUAGES if t.split()[0].startswith(tuple(LANGUAGES[l]))) for i, t, _ in rows}
    docs = documents(rows + [(1000, None, "aa"), (1001, "12 -- 3", "bb"), (1002, "", None), (None, "kaki tatu", None)])
    unseen = lid.held_out()
    model = lid.fit(docs, ~unseen)
    found = lid.identify(docs, model).select("doc_id", unseen.alias("held"), "lang_pred", "lang_score").collect()
    for r in found:
        assert r.held == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.lang_score <= 1
    rows = {r.doc_id: r for r in found}
    assert [rows[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and rows[1000].lang_score == 0
    held = [r for r in found if r.held and r.doc_id < 1000]
    assert len(held) > 60 and all(r.lang_pred == truth[r.doc_id] for r in held)
    assert rows[None].lang_pred in LANGUAGES


def test_without_labels_and_clashing_columns(documents):
    docs = documents([(1, "abc", None, "s", 3, 4)], ", lang_pred int, found int")
    model = lid.fit(docs, F.lit(True))
    row = lid.identify(docs, model).first()
    assert (row.lang_pred, row.lang_score, row.found) == ("und", 0.0, 4)
    assert lid.identify(documents([]), lid.fit(documents([]), F.lit(True))).count() == 0


def test_many_letters_and_one_language():
    many = "".join(chr(0x4E00 + i) for i in range(600))
    model = lid.build({"zh": [many]}, 1000)
    names, scores = lid.classify([many, "\U00020000", None], model)
    assert names == ["zh", "zh", "und"] and np.allclose(scores, [1, 1, 0])


def test_no_letter_is_taken_for_another():
    rng = random.Random(9)
    shared = [chr(0x4E00 + i) for i in range(240)]
    own = {"xx": [chr(0x5E00 + i) for i in range(400)], "yy": [chr(0x6E00 + i) for i in range(400)]}

    def line(lang, n):
        return "".join(rng.choice(shared) if rng.random() < 0.7 else rng.choice(own[lang]) for _ in range(n))

    model = lid.build({lang: [line(lang, 500) for _ in range(48)] for lang in own}, 24_000)
    truth = [rng.choice(list(own)) for _ in range(200)]
    names, _ = lid.classify([line(lang, rng.randint(10, 60)) for lang in truth], model)
    assert sum(a == b for a, b in zip(names, truth)) >= 190
    assert model.table.nbytes < 200e6
