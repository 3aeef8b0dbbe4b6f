"""Best-fit packing of token pieces into sequences, certified by dual feasible functions.

Pieces are dealt evenly over partitions of a bounded size; each partition packs its pieces best-fit
decreasing and compares its number of sequences with the best lower bound that dual feasible
functions give. In a partition whose number equals the bound, the packing is proved optimal and only
its least filled sequence stays open; in one with a gap all sequences with room stay open. The
pieces of open sequences are exchanged between partitions and packed again, as long as that saves
sequences.

Defined results: a NULL text is empty and gives one piece with the closing id alone. Repeated rows
are documents of their own. An empty table gives no rows. Only lengths and passed-on columns are
shuffled; a document longer than a sequence is cut, and its first piece is the shorter one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from struct import pack as pack_bytes
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.common import column, saved

CAPACITY = 1024
CLOSING_ID = 2
PER_TASK = 50_000
ROUNDS = 4
CHUNK_CHARS = 1_000_000
CACHED_WORDS = 600_000
JOINED_CHARS = 50_000
# Below this code point every edition of Unicode in use agrees on what is a letter.
STABLE_LETTERS = "\u0530"
# Marks that may close a word: neither letters, numbers nor spaces; an apostrophe begins endings.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

# In byte-level BPE a space before a non-space always begins a new token, so texts may be cut there.
_ODD_SPACE = re.compile(r" (?:\s|$)")
_CUT = re.compile(r" (?=\S)")


class _Parts(dict):
    """part -> ids of a space and the part; a part that is not in it is asked of ``make``."""

    def __init__(self, make: Callable[[str], bytes | None]) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, part: str) -> bytes | None:
        return self.make(part)


class _Words:
    """Little-endian ids of the parts of texts between such spaces, encoded when first met.

    A new part of which each line is letters, or letters and then marks, needs no pattern to be
    split, so its letters go to the tokenizer's merges directly. Other new parts of a group of texts
    are encoded joined, which costs less than one by one; the offsets of the tokens tell them apart.
    The memory is emptied when it is full.
    """

    def __init__(self, path: str, remembered: int | None = None) -> None:
        self.remembered = remembered or CACHED_WORDS
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.merged = self.tokenizer.model.tokenize
        # Special strings may stand anywhere in a part, so a text that has one is encoded whole.
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        if any(" " in token for token in self.special):
            raise ValueError("special tokens with spaces are not supported")
        # The letters that byte-level BPE writes for the bytes, which keep their order in two runs.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [byte for byte in range(256) if byte not in shown]
        self.letters = {byte: chr(0x100 + i) for i, byte in enumerate(hidden)}
        self.space = self.letters[0x20]
        if set(ByteLevel.alphabet()) != {*map(chr, shown), *self.letters.values()} or self._word(" né") != self._plain(" né"):
            raise ValueError("not a byte-level BPE tokenizer")
        self.known = _Parts(self._met)
        self.marks: dict[str, bytes] = {"": b""}
        self.line = self._plain("\n")
        probes = [f"né{mark}\nÉne{mark}\nen" for mark in (*MARKS, MARKS, "")]
        self.simple = True
        # Another pattern than the usual one may take marks, line ends and letters together.
        self.simple = all(self._met(probe) == self._plain(" " + probe) for probe in probes)
        self.missed: list[str] = []

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, letters: str) -> bytes:
        """Ids of letters, which a space may precede."""
        if letters.isascii():
            shown = letters.replace(" ", self.space)
        else:
            shown = letters.encode().decode("latin-1").translate(self.letters)
        tokens = self.merged(shown)
        return pack_bytes("<%dI" % len(tokens), *[token.id for token in tokens])

    def _met(self, part: str) -> bytes | None:
        """Ids of a space and a new part; None where the pattern is needed, and the part is noted."""
        known = self.known
        if part.isalpha() and (part.isascii() or max(part) < STABLE_LETTERS):
            ids = known[part] = self._word(" " + part)
            return ids
        found, lines = [], part.split("\n")
        for n, line in enumerate(lines):
            letters = line.rstrip(MARKS)
            if not (self.simple and letters.isalpha() and (letters.isascii() or max(letters) < STABLE_LETTERS)):
                self.missed.append(part)
                return None
            if n:  # no part begins with a line end
                key = "\n" + letters
                if (ids := known.get(key)) is None:
                    ids = known[key] = self.line + self._word(letters)
            elif (ids := known.get(letters)) is None:
                ids = known[letters] = self._word(" " + letters)
            mark = line[len(letters) :]
            if (closing := self.marks.get(mark)) is None:
                closing = self._plain(mark)
                if len(mark) < 4:
                    self.marks[mark] = closing
            found += (ids, closing)
        whole = b"".join(found)
        if len(lines) == 1 and mark:  # two words round a line end hardly meet again
            known[part] = whole
        return whole

    def _learn(self, parts: list[str]) -> None:
        known, at = self.known, 0
        while at < len(parts):
            some, chars = [], 0
            while at < len(parts) and chars < JOINED_CHARS:
                some.append(parts[at])
                chars += len(parts[at]) + 1
                at += 1
            found = self.tokenizer.encode(" " + " ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, dtype="<u4")
            begins = np.fromiter((begin for begin, _ in found.offsets), dtype=np.int64, count=len(ids))
            starts = np.cumsum([0, *[len(part) + 1 for part in some[:-1]]])
            # An offset may leave out the space, but it stays within its part.
            cuts = [*np.searchsorted(begins, starts).tolist(), len(ids)]
            data = ids.tobytes()
            for part, a, b in zip(some, cuts[:-1], cuts[1:]):
                known[part] = data[4 * a : 4 * b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self.known) > self.remembered:
            self.known.clear()
        cut = [[text] if any(token in text for token in self.special) else (_CUT.split if _ODD_SPACE.search(text) else _split)(text) for text in texts]
        heads = [parts.pop(0) for parts in cut]
        known, ids, holes = self.known.__getitem__, [], []
        self.missed = []
        for i, parts in enumerate(cut):
            before = len(self.missed)
            ids.append(list(map(known, parts)))
            if len(self.missed) > before:
                holes.append(i)
            else:
                ids[i] = b"".join(ids[i])
        self._learn(list(dict.fromkeys(self.missed)))
        for i in holes:
            ids[i] = b"".join([known(part) if found is None else found for part, found in zip(cut[i], ids[i])])
        plain = self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)
        return [np.array(head.ids, dtype="<u4").tobytes() + rest for head, rest in zip(plain, ids)]


def _split(text: str) -> list[str]:
    return text.split(" ")


@lru_cache(maxsize=2)
def _words(path: str, remembered: int) -> _Words:
    return _Words(path, remembered)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    closing: int = CLOSING_ID,
    remembered: int = CACHED_WORDS,
    forget: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids`` of every document; ``ids`` are little-endian 32-bit numbers.

    A worker remembers the ids of up to ``remembered`` parts of texts, at about 200 bytes each, also
    for its later tasks. With ``forget`` it drops them at the end of a task, because an idle worker
    would hold that memory beside whatever runs next on the executor.
    """
    kept = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    schema = T.StructType(
        [
            kept.schema["doc_id"],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    end = np.uint32(closing).astype("<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = _words(tokenizer, remembered)
        row, piece, start, length, ids = [], [], [], [], []
        for i, found in enumerate(words.encode([value or "" for value in batch.column(1).to_pylist()])):
            whole = found + end
            total = len(whole) // 4
            first = total % capacity or capacity
            cuts = [0, *range(first, total + 1, capacity)]
            for number, (a, b) in enumerate(pairwise(cuts)):
                row.append(i)
                piece.append(number)
                start.append(a)
                length.append(b - a)
                ids.append(whole[4 * a : 4 * b])
        taken = batch.column(0).take(pa.array(row, pa.int64()))
        columns = [taken, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, int(batch.num_rows * CHUNK_CHARS // max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                yield cut(batch.slice(at, step))
        if forget:
            _words(tokenizer, remembered).known.clear()
            pa.default_memory_pool().release_unused()

    return kept.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, fill of each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    fill: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin with room r exists
    for i, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = b, fill[b]
        fill[b] += size
        room -= size
        if room:
            by_room[room].append(b)
            rooms |= 1 << room
    return bins, offsets, np.array(fill, dtype=np.int64)


def lower_bound(lengths: np.ndarray, capacity: int, rounding: int = 24) -> int:
    """Most bins that a dual feasible function proves necessary.

    Two families: sizes above ``capacity - e`` count as full and those below ``e`` as nothing, for
    each e up to half the capacity; and sizes rounded down to multiples of 1/k, for each k up to
    ``rounding``, with exact multiples of 1/(k+1) kept.
    """
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1, dtype=np.int64)
    mass = np.concatenate([[0], np.cumsum(count * size)])
    number = np.concatenate([[0], np.cumsum(count)])
    e = np.arange(0, capacity // 2 + 1)
    top = capacity - e + 1  # sizes from here count as full
    kept = mass[top] - mass[e]
    best = int(np.max(-(-(kept + capacity * (number[-1] - number[np.minimum(top, capacity + 1)])) // capacity)))
    for k in range(1, rounding + 1):
        exact = (k + 1) * size % capacity == 0
        # In units of capacity * k.
        value = np.where(exact, k * size, (k + 1) * size // capacity * capacity)
        best = max(best, int(-(-int((count * value).sum()) // (capacity * k))))
    return best


class Packing(NamedTuple):
    placed: DataFrame  # the pieces with sequence_id and offset
    certificates: DataFrame  # turn, part, sequences, bound, pieces of every partition packed


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY, per_task: int = PER_TASK, rounds: int = ROUNDS) -> Packing:
    """Place every piece (``length`` from 1 to ``capacity``); columns ``sequence_id`` and ``offset`` are added or replaced."""
    own = ["sequence_id", "offset", "turn", "part", "sequences", "bound", "pieces", "open"]
    kept = [name for name in pieces.columns if name not in own]
    pool = saved(pieces.select(*map(column, kept)), "packing-pieces")
    schema = T.StructType(
        [
            *pool.schema.fields,
            *(T.StructField(name, T.LongType()) for name in own[:-1]),
            T.StructField("open", T.BooleanType()),
        ]
    )

    def packer(turn: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            part = TaskContext.get().partitionId()
            rows = [batch for batch in batches if len(batch)]
            if not rows:
                return
            rows = pd.concat(rows, ignore_index=True)
            sizes = rows[length].to_numpy(dtype=np.int64)
            bins, offsets, fill = best_fit(sizes, capacity)
            bound = lower_bound(sizes, capacity)
            if len(fill) == bound:
                still = np.arange(len(fill)) == fill.argmin()
            else:
                still = np.ones(len(fill), dtype=bool)
            still &= fill < capacity
            number = (turn << 56) + (part << 32) + bins
            yield rows.assign(
                sequence_id=number, offset=offsets, turn=turn, part=part, sequences=len(fill), bound=bound, pieces=len(rows), open=still[bins]
            )

        return run

    done, made, before = [], [], None
    for turn in range(rounds):
        parts = max(1, -(-pool.count() // per_task))
        packed = saved(pool.select(*map(column, kept)).repartition(parts).mapInPandas(packer(turn), schema), "packing-turn")
        made.append(packed.select("turn", "part", "sequences", "bound", "pieces").distinct())
        starts = packed.where("offset = 0").groupBy().agg(F.count(F.lit(1)).alias("all"), F.count_if("open").alias("open")).first()
        if before is not None and starts["all"] >= before:  # the exchange saved nothing
            done.append(pool)
            break
        if parts == 1 or turn == rounds - 1 or not starts["open"]:
            done.append(packed)
            break
        done.append(packed.where("not open"))
        pool, before = packed.where("open"), starts["open"]
    placed = [frame.select(*map(column, kept), "sequence_id", "offset") for frame in done]
    result, certificates = placed[0], made[0]
    for frame in placed[1:]:
        result = result.unionByName(frame)
    for frame in made[1:]:
        certificates = certificates.unionByName(frame)
    return Packing(result, certificates)


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed token ids: ``sequence_id, ids`` with the pieces of a sequence in the order of their offsets."""
    parts = F.array_sort(F.collect_list(F.struct("offset", column(ids).alias("ids"))))
    joined = F.aggregate(parts, F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"))
