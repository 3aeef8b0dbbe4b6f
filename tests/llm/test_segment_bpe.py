"""Byte-level BPE against the tiktoken library, brute-force merging and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from surveylake.llm import segment_bpe
from surveylake.llm.queries import RANKS, op13_byte_bpe, tokenizer_path

PATTERN = public_tokenizers.PATTERN
SIGNS = ["a", "B", "é", "1", ".", "'s", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "᠎", "😀", "_", "ｱ", ",", "né", "中", "ʰ", "²", "́", "?!", "the", "<|endoftext|>"]


@pytest.fixture(scope="module")
def path():
    return tokenizer_path(RANKS)


@pytest.fixture(scope="module")
def library(path):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=segment_bpe.load_ranks(path), special_tokens={})


def ids_of(data):
    return np.frombuffer(data, dtype="<i4").tolist()


def test_ids_are_those_of_the_library(path, library, monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices(SIGNS, k=rng.randint(0, 40))) for _ in range(2500)]
    texts += ["a" * 3000, "".join(rng.choices("abcdeinorst", k=9000)), "中文" * 900, "word " * 20_000, " " * 700 + "x"]
    monkeypatch.setattr(segment_bpe, "REMEMBERED", 500)
    monkeypatch.setattr(segment_bpe, "LOCKSTEP_CELLS", 300)
    encoder = segment_bpe.Encoder(path, PATTERN)
    for at in range(0, len(texts), 40):
        for text, found in zip(texts[at : at + 40], encoder.encode(texts[at : at + 40])):
            assert ids_of(found) == library.encode_ordinary(text), repr(text[:80])


def test_characters_of_any_edition_of_unicode(path, library):
    encoder = segment_bpe.Encoder(path, PATTERN)
    disputed = sorted(segment_bpe._stand_ins())
    some = disputed[:: max(1, len(disputed) // 400)] + list(range(0x530, 0x2FFF, 7)) + list(range(0x10000, 0x1FFFF, 61))
    for code in some:
        text = f"a{chr(code)}b 1{chr(code)}2 .{chr(code)}. {chr(code)} {chr(code)}c"
        assert ids_of(encoder.encode([text])[0]) == library.encode_ordinary(text), hex(code)


def brute_force(part, ranks):
    parts = [part[i : i + 1] for i in range(len(part))]
    while True:
        joined = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not joined:
            return [ranks[p] for p in parts]
        at = min(joined)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_merges_follow_the_leftmost_least_pair():
    rng = random.Random(6)
    for _ in range(40):
        tokens = [bytes([b]) for b in range(256)]
        while len(tokens) < 256 + 25:
            token = bytes(rng.choices(b"abc", k=rng.randint(2, 5)))
            if token not in tokens:
                tokens.append(token)
        order = list(range(len(tokens)))
        rng.shuffle(order)  # ranks need not grow with length, and parts of a token need not be tokens
        merger = segment_bpe.Merger(dict(zip(tokens, order)))
        parts = [bytes(rng.choices(b"abc", k=rng.randint(2, 33))) for _ in range(40)]
        for part, found in zip(parts, merger.merge_many(parts)):
            assert found.tolist() == brute_force(part, merger.ranks) == merger.merge_one(part)


def test_a_vocabulary_of_bytes_alone():
    merger = segment_bpe.Merger({bytes([b]): b for b in range(256)})
    assert [p.tolist() for p in merger.merge_many([b"ab"])] == [[97, 98]] and merger.merge_one(b"abc") == [97, 98, 99]
    with pytest.raises(ValueError):
        segment_bpe.Merger({b"a": 0})


def test_round_trip_of_odd_rows(spark, documents, path, library):
    texts = ["", None, " ", "héllo wörld", "\x00\x01", "same", "same", "word " * 30_000, "x" * 4000, "".join(SIGNS)]
    docs = documents([(i if i != 2 else None, t) for i, t in enumerate(texts)])
    docs = docs.withColumn("IDS", F.lit("own")).withColumn("a.b", F.lit(7))
    out = docs.withColumn("ids_", segment_bpe.encode(F.col("text"), path, PATTERN))
    rows = out.withColumn("bytes", segment_bpe.decode(F.col("ids_"), path)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids_ == library.encode_ordinary(row.text or "") and (row["a.b"], row["IDS"]) == (7, "own")
        assert bytes(row.bytes) == (row.text or "").encode()
    assert documents([]).select(segment_bpe.encode(F.col("text"), path, PATTERN)).count() == 0
    gone = spark.createDataFrame([(None,), ([],)], "ids array<int>").select(segment_bpe.decode(F.col("ids"), path).alias("b"))
    assert [r.b for r in gone.collect()] == [None, b""]


def test_the_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op13_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
