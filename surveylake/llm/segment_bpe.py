"""Byte-level BPE encoding with a segment tree of pair ranks, and decoding.

A text is split by a pattern; each match is encoded on its own. A match that is a token as a whole
is that token. Otherwise a segment tree over its byte positions holds, at the position where a live
part begins, the rank of that part joined with the next one; its root is the leftmost pair of the
least rank. A merge joins that pair, and three point updates (the joined part, the part it swallowed
and the live neighbour before) climb the tree, so a match of n bytes costs O(n log n) at most.

Short matches are merged in lockstep: their trees are rows of one array, and each step is one merge
in every match that still has a pair. Long ones have a tree of their own. A match met before is
looked up; that memory is emptied when it is full, which costs time only.

Defined results: a NULL text is empty and has no ids. Texts are encoded whole, whatever their
length, and strings that look like special tokens are ordinary text. Rows are independent, so
repeated rows and an empty table need no rule. Both functions take and give columns, so a table may
have other columns of any names. Decoding a NULL gives NULL, an unknown id is an error.
The ids are those of the tiktoken library: on characters that its edition of Unicode classes otherwise
than the pattern engine used here, the library itself is asked for the class.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Matches up to this number of bytes are merged in lockstep.
LOCKSTEP_BYTES = 64
# Cells of the trees that are merged at once (8 bytes each).
LOCKSTEP_CELLS = 1 << 21
# Distinct matches a Python worker remembers.
REMEMBERED = 400_000
CHUNK_CHARS = 1_000_000

# Below this code point every edition of Unicode in use classes characters alike.
_LATE = re.compile("[\u0530-\U0010ffff]")
_NONE = np.int64(2**62)  # no pair begins here


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a token in base 64 and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merger:
    """Merges the bytes of matches by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.ranks = ranks
        self.first = np.array([ranks[bytes([byte])] for byte in range(256)], dtype=np.int64)
        # Every way to put a token together from two tokens, as left << 32 | right.
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.joined = np.array([pairs[key] for key in self.keys.tolist()], dtype=np.int64)

    def _leaves(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Leaf values ``rank << 32 | position`` of pairs; ``_NONE`` where the pair is no token."""
        key = left << 32 | right
        if not len(self.keys):
            return np.full(len(key), _NONE)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.joined[at] << 32 | position, _NONE)

    def merge_many(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of matches of 2 to ``LOCKSTEP_BYTES`` bytes each, one merge a step in all of them."""
        found: list[np.ndarray] = [None] * len(parts)  # type: ignore[list-item]
        by_width: dict[int, list[int]] = {}
        for i, part in enumerate(parts):
            by_width.setdefault(1 << (len(part) - 1).bit_length(), []).append(i)
        for width, members in by_width.items():
            step = max(1, LOCKSTEP_CELLS // (2 * width))
            for at in range(0, len(members), step):
                some = members[at : at + step]
                for i, ids in zip(some, self._lockstep([parts[i] for i in some], width)):
                    found[i] = ids
        return found

    def _lockstep(self, parts: list[bytes], width: int) -> list[np.ndarray]:
        n = len(parts)
        size = np.fromiter(map(len, parts), dtype=np.int64, count=n)
        padded = np.frombuffer(b"".join(part.ljust(width, b"\0") for part in parts), dtype=np.uint8).reshape(n, width)
        place = np.arange(width)
        # One more place on each side: -1 and width stand for "no neighbour".
        token = np.full((n, width + 1), -1, dtype=np.int64)
        token[:, :width] = np.where(place < size[:, None], self.first[padded], -1)
        after = np.tile(np.arange(1, width + 1), (n, 1))
        after = np.where(after < size[:, None], after, width)
        before = np.tile(place - 1, (n, 1))
        tree = np.full((n, 2 * width), _NONE)
        rows, columns = np.nonzero(after < width)
        tree[rows, width + columns] = self._leaves(token[rows, columns], token[rows, columns + 1], columns)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def update(row: np.ndarray, leaf: np.ndarray, value: np.ndarray | np.int64) -> None:
            node = width + leaf
            tree[row, node] = value
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        live = np.nonzero(tree[:, 1] < _NONE)[0]
        while len(live):
            best = tree[live, 1]
            at, swallowed = best & 0xFFFFFFFF, after[live, best & 0xFFFFFFFF]
            beyond = after[live, swallowed]
            token[live, at] = best >> 32
            token[live, swallowed] = -1
            after[live, at] = beyond
            inside = beyond < width
            before[live[inside], beyond[inside]] = at[inside]
            update(live, swallowed, _NONE)
            # A pair with the place beyond the end has token -1 and so no rank.
            update(live, at, self._leaves(best >> 32, token[live, beyond], at))
            lead = before[live, at]
            some = lead >= 0
            if some.any():
                row, lead = live[some], lead[some]
                update(row, lead, self._leaves(token[row, lead], (best >> 32)[some], lead))
            live = live[tree[live, 1] < _NONE]
        kept = token[:, :width]
        flat = kept[kept >= 0].astype("<i4")
        return np.split(flat, np.cumsum((kept >= 0).sum(axis=1))[:-1])

    def merge_one(self, part: bytes) -> list[int]:
        """Ids of one match of any length."""
        n = len(part)
        width = 1 << max(1, (n - 1).bit_length())
        get, none = self.pairs.get, int(_NONE)
        token = self.first[np.frombuffer(part, dtype=np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def leaf(a: int, b: int) -> int:
            rank = get(token[a] << 32 | token[b])
            return none if rank is None else rank << 32 | a

        tree = [none] * (2 * width)
        for i in range(n - 1):
            tree[width + i] = leaf(i, i + 1)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def update(place: int, value: int) -> None:
            node = width + place
            tree[node] = value
            while node > 1:
                least = min(tree[node], tree[node ^ 1])
                node >>= 1
                if tree[node] == least:
                    return
                tree[node] = least

        while tree[1] < none:
            at, rank = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            swallowed = after[at]
            beyond = after[swallowed]
            token[at], token[swallowed] = rank, -1
            after[at] = beyond
            update(swallowed, none)
            if beyond < n:
                before[beyond] = at
                update(at, leaf(at, beyond))
            else:
                update(at, none)
            if before[at] >= 0:
                update(before[at], leaf(before[at], at))
        return [found for found in token if found >= 0]


@lru_cache(maxsize=1)
def _stand_ins() -> dict[int, str]:
    """A character of the right class for every character whose class is disputed.

    Disputed are those that the pattern engine and Python's own tables class as letter, number, space
    or other in different ways, as they follow different editions of Unicode. The tiktoken library
    settles them: in its encoding by two-byte tokens a character joins the one before it only if the
    pattern puts both into one match.
    """
    import tiktoken

    every = "".join(chr(code) for code in range(sys.maxunicode + 1) if not 0xD800 <= code < 0xE000)
    seen = [set(regex.findall(kind, every)) for kind in (r"\p{L}", r"\p{N}", r"\s")]

    def disputed(letter: str) -> bool:
        kind = unicodedata.category(letter)[0]
        blank = kind == "Z" or letter in "\t\n\v\f\r\x85"
        return [letter in group for group in seen] != [kind == "L", kind == "N", blank]

    asked = list(filter(disputed, every))
    samples = {"a": "a", "1": "1", ".": "."}
    ranks = {bytes([byte]): byte for byte in range(256)}
    for lead in samples:
        for byte in range(128, 256):
            ranks[lead.encode() + bytes([byte])] = len(ranks)
    pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
    library = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    found = {}
    for letter in asked:
        joined = [sample for lead, sample in samples.items() if library.encode_ordinary(lead + letter)[0] > 255]
        found[ord(letter)] = joined[0] if joined else "\u2003"
    return found


class Encoder:
    """Little-endian 32-bit ids of texts."""

    def __init__(self, path: str, pattern: str) -> None:
        self.merger = Merger(load_ranks(path))
        self.pattern = regex.compile(pattern)
        self.known: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """Matches of the pattern, by the library's classes of characters."""
        if text.isascii() or not _LATE.search(text):
            return self.pattern.findall(text)
        classed = text.translate(_stand_ins())
        if classed == text:
            return self.pattern.findall(text)
        return [text[slice(*match.span())] for match in self.pattern.finditer(classed)]

    def _learn(self, matches: list[str]) -> None:
        short: list[tuple[str, bytes]] = []
        for match in matches:
            data = match.encode()
            rank = self.merger.ranks.get(data)
            if rank is not None:
                self.known[match] = rank.to_bytes(4, "little")
            elif len(data) <= LOCKSTEP_BYTES:
                short.append((match, data))
            else:
                self.known[match] = np.array(self.merger.merge_one(data), dtype="<i4").tobytes()
        for (match, _), ids in zip(short, self.merger.merge_many([data for _, data in short])):
            self.known[match] = ids.tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        cut = [self.split(text) for text in texts]
        self._learn(list({match for matches in cut for match in matches if match not in self.known}))
        get = self.known.__getitem__
        return [b"".join(map(get, matches)) for matches in cut]


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in load_ranks(path).items()}


def encode(text: Column, path: str, pattern: str) -> Column:
    """The token ids of a text column, an array of int."""

    def ids(batch: pa.Array) -> pa.Array:
        encoder, lists, at = _encoder(path, pattern), [], 0
        sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch), 0).to_numpy())
        while at < len(batch):  # some texts at a time, one at least
            done = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + CHUNK_CHARS)))
            found = encoder.encode([text or "" for text in batch.slice(at, end - at).to_pylist()])
            ends = np.cumsum([0, *(len(part) // 4 for part in found)])
            values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"), pa.int32())
            lists.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
            at = end
        return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    ids.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(ids, T.ArrayType(T.IntegerType()))(text)


def decode(ids: Column, path: str) -> Column:
    """The bytes that the tokens of an array of ids stand for."""

    def joined(batch: pa.Array) -> pa.Array:
        tokens = _tokens(path).__getitem__
        values, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
        null = batch.is_null().to_pylist()
        rows = zip(ends[:-1].tolist(), ends[1:].tolist(), null)
        return pa.array([None if gone else b"".join(map(tokens, values[a:b].tolist())) for a, b, gone in rows], pa.binary())

    joined.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    # Spark chains functions called on each other's results, and would encode once more for the chain.
    return F.arrow_udf(joined, T.BinaryType())(F.when(F.size(ids) >= 0, ids))
