"""64-bit hashes of all words of a batch of texts, computed on byte arrays."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse; those of the usual block are kept."""
    if n > BLOCK:  # a word longer than a block
        return _powers(_MULTIPLIER, n), _powers(_INVERSE, n)
    if not _POWERS:
        _POWERS[BLOCK] = (_powers(_MULTIPLIER, BLOCK), _powers(_INVERSE, BLOCK))
    return _POWERS[BLOCK]


def _block(data: np.ndarray, hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of a block that splits no word."""
    space = _SPACE[data]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not hashed:
        return np.zeros(0, dtype=np.uint64), starts, ends
    power, inverse = _tables(len(data))
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(hashes ^ (ends - starts).astype(np.uint64)), starts, ends


def word_hashes(texts: list[str], hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words (runs without ASCII white space) of all texts in order.

    Returns the hashes, the first word of each text (one entry more than texts), and each word's
    first and last byte place in its text. Working memory is a few blocks of one MiB besides the
    result; only a single word longer than that is taken whole. Unless ``hashed`` there are places only.
    """
    encoded = [text.encode("utf-8", "replace") for text in texts]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(part) + 1 for part in encoded], out=offsets[1:])
    data = np.frombuffer(b"\n".join(encoded), dtype=np.uint8)
    hashes, starts, ends, at = [], [], [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        if end < len(data):
            cut = np.flatnonzero(_SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:
                while end < len(data) and not _SPACE[data[end]]:
                    end += 1
        h, s, e = _block(data[at:end], hashed)
        hashes.append(h)
        starts.append(s + at)
        ends.append(e + at)
        at = end
    if not hashes:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), np.zeros(len(texts) + 1, dtype=np.int64), none, none
    start, stop = np.concatenate(starts), np.concatenate(ends)
    first = np.searchsorted(start, offsets)
    base = np.repeat(offsets[:-1], np.diff(first))
    return np.concatenate(hashes), first, start - base, stop - base


_MIXERS = (mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)).tolist()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of ``size`` words; a shorter text is one window, an empty text none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for j in range(width):
        total += hashes[j : n - width + 1 + j] * np.uint64(_MIXERS[j])
    return mix(total ^ np.uint64(width))
