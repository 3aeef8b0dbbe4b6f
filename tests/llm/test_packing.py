"""Packing against brute force, bounds, and an exact round trip of token ids."""

import itertools
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from surveylake.llm import packing
from surveylake.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


ODD = ["", " ", "  a  b ", "a\n b", "x \n\n  y\t z", "don't  stop 12 34", "é à b", "a  b c", "tail ", "\x1c a \x1c", "<|endoftext|> a", "a <|endoftext|> b", "x y<|endoftext|>z <|endoftext", "<|endoftext|>"]


def test_ids_are_those_of_the_whole_text(tokenizer, monkeypatch):
    rng = np.random.default_rng(8)
    signs = ["a", "B", "é", "1", ".", "'s", " ", " ", "  ", "\n", "\t", "\x1c", "\u00a0", "\u2003", "😀", "_", "ｱ", ",", "ab", "né", "中", "ʰ", "²", "́", "?!", "<|endoftext|>"]
    texts = ODD + ["".join(rng.choice(signs, rng.integers(1, 25))) for _ in range(1500)]
    monkeypatch.setattr(packing, "JOINED_CHARS", 40)
    monkeypatch.setattr(packing, "CACHED_WORDS", 300)
    words = packing._Words(tokenizer_path())
    for at in range(0, len(texts), 50):
        for text, found in zip(texts[at : at + 50], words.encode(texts[at : at + 50])):
            assert np.frombuffer(found, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_lines_of_words_and_marks_need_no_pattern(tokenizer, monkeypatch):
    words, joined = packing._Words(tokenizer_path()), []
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda parts: (joined.extend(parts), learn(parts)))
    text = "One word.\nThen né!!\nSo,\nÉté $$$ of%%% (it's 3rd x\n\ny end.\nOne"
    for _ in range(2):
        ids = np.frombuffer(words.encode([text])[0], dtype="<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids
    assert joined == ["$$$", "(it's", "3rd", "x\n\ny"]


def fewest(sizes, capacity):
    best = len(sizes)
    for order in set(itertools.permutations(sizes)):
        bins = [0]
        for size in order:
            if bins[-1] + size > capacity:
                bins.append(0)
            bins[-1] += size
        best = min(best, len(bins))
    return best


def test_bounds_and_best_fit_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        sizes = rng.integers(1, 13, size=rng.integers(1, 7))
        optimum = fewest(sizes.tolist(), 12)
        bins, offsets, fill = packing.best_fit(sizes, 12)
        assert packing.lower_bound(sizes, 12) <= optimum <= len(fill)
        assert fill.max() <= 12
        for b in range(len(fill)):
            spans = sorted(zip(offsets[bins == b], sizes[bins == b]))
            assert [o for o, _ in spans] == [sum(s for _, s in spans[:i]) for i in range(len(spans))]


def test_bound_proves_what_the_sum_cannot():
    assert packing.lower_bound(np.array([7, 7, 7]), 12) == 3
    assert packing.lower_bound(np.array([5, 5, 5, 5]), 12) == 2


def test_documents_round_trip(spark, documents, words, tokenizer):
    texts = [" ".join(words(n)) for n in (1, 5, 700, 2500, 40, 40, 900, 3)] + ["", None, "same", "same"]
    docs = documents([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (11, "same")])
    pieces = packing.token_pieces(docs, tokenizer_path())
    placed = packing.pack(pieces).placed
    rows = placed.orderBy("doc_id", "piece").collect()
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    for row in rows:
        at = 4 * row.offset
        assert whole[row.sequence_id][at : at + 4 * row.length] == bytes(row.ids)
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = [r for r in rows if r.doc_id == i]
        own = own[:1] if i == 11 else own  # a repeated row
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, dtype="<u4").tobytes()
        assert [r.start for r in own] == [sum(r.length for r in own[:n]) for n in range(len(own))]
        assert all(r.length == 1024 for r in own[1:])
    assert sum(r.doc_id == 11 for r in rows) == 2 and sum(r.doc_id is None for r in rows) == 1
    assert all(len(ids) <= 4096 for ids in whole.values())
    checks = pieces.select("ids", F.crc32("ids").alias("crc")).collect()
    assert all(r.crc == zlib.crc32(bytes(r.ids)) for r in checks)


def test_partitions_exchange_what_is_open(spark):
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1025, size=3000)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "id long, length long")
    found = packing.pack(pieces, per_task=500)
    filled = found.placed.groupBy("sequence_id").agg(F.sum("length").alias("fill"), F.min("offset").alias("low"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in filled) == 3000 and all(r.fill <= 1024 and r.low == 0 for r in filled)
    bound = packing.lower_bound(sizes, 1024)
    assert len(filled) <= 1.03 * bound
    first = found.certificates.where("turn = 0").groupBy().agg(F.sum("sequences").alias("n")).first().n
    assert len(filled) <= first
    assert all(r.sequences >= r.bound for r in found.certificates.collect())


def test_empty_table(spark, documents):
    pieces = packing.token_pieces(documents([]), tokenizer_path())
    assert packing.pack(pieces).placed.count() == 0


def test_other_columns_and_clashing_names(spark):
    pieces = spark.createDataFrame([(5, "x", 1), (7, "y", 2)], "length long, `sequence_id` string, open int")
    placed = packing.pack(pieces).placed
    assert sorted(placed.columns) == ["length", "offset", "sequence_id"] and placed.count() == 2


@pytest.mark.parametrize("stage", [True, False])
def test_workers_of_the_pipeline_forget_the_parts_of_texts(spark, documents, words, stage):
    remembered = 1234 + stage  # a memory of this test's own
    docs = documents([(i, " ".join(words(30))) for i in range(400)]).repartition(8)
    if stage:
        import corpus_pipeline

        remembered = packing.CACHED_WORDS
        corpus_pipeline.pack_sequences(spark, docs, "").count()
    else:
        packing.token_pieces(docs, tokenizer_path(), remembered=remembered, forget=True).write.format("noop").mode("overwrite").save()

    def held(batches):
        from surveylake.llm.packing import _words

        path = tokenizer_path()
        for _ in batches:
            pass
        yield pd.DataFrame({"n": [len(_words(path, remembered).known)]})

    assert spark.range(8).repartition(8).mapInPandas(held, "n long").agg(F.max("n")).first()[0] == 0
