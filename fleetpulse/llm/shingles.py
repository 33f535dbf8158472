"""Word shingles of whole texts as 64-bit hashes, by numpy inside Arrow batches."""

from collections.abc import Iterator

import numpy as np

WIDTH = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_WHITE = np.zeros(256, bool)
_WHITE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word: runs without white space, with A-Z in lower case."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_WHITE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    # sum of byte * odd ** position over a word, taken back to the word's start by the inverse power
    place = np.arange(len(data) + 1, dtype=np.int64)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[place[:-1]], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_TABLES[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_ODD), -1, 2**64))
        _TABLES[:] = [np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)])) for x in (_ODD, inverse)]
    return _TABLES


def shingle_set(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of all 5-word shingles; a shorter text is one shingle as a whole."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(WIDTH, len(words))
    held = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        held = mixed(held * _ODD + words[k : len(words) - width + 1 + k])
    return np.unique(held)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    return int((b[place] == a).sum())


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both) > 0


def texts_of(column) -> Iterator[bytes]:
    for text in column:
        yield text.as_py().encode()
