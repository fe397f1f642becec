"""Texts as arrays of word hashes, and rolling hashes of word windows."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd multipliers, so that no bit of a hash is lost.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)

ASCII_LOWER = bytes(range(256)).lower()


class WordHashes(dict):
    """64-bit hashes of words, kept for as long as they stay a bounded number."""

    MOST = 200_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.MOST:
            self[word] = value
        return value


_hashes = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def texts_to_words(texts: list[bytes], translation: bytes | None = None) -> tuple:
    """Word hashes of all texts one behind the other, and where each text begins and ends.

    Words are runs of bytes that are no ASCII white space, after `translation` byte by byte.
    """
    arrays, ends = [], np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        words = (text.translate(translation) if translation else text).split()
        arrays.append(word_hashes(words))
        ends[i + 1] = ends[i] + len(words)
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)), ends


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PIECE = 1 << 20  # bytes hashed at a time
BASES = (0xA24BAED4963EE407, 0x9FB21C651E98DF25)  # odd, so that they have inverses
_powers: dict[int, list[np.ndarray]] = {}


def _power_tables(n: int, base: int) -> list[np.ndarray]:
    """Powers of the base modulo 2^64, and those of its inverse."""
    if base not in _powers or len(_powers[base][0]) < n:
        tables = [np.full(n, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
        for table in tables:
            table[0] = 1
            np.multiply.accumulate(table, out=table)
        _powers[base] = tables
    return _powers[base]


def run_hashes(hashes: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """Like `windows`, for the cost of one pass: differences of running sums."""
    n = max(0, len(hashes) - size + 1)
    out = np.empty(n, np.uint64)
    for start in range(0, n, 1 << 16):
        part = hashes[start : min(n, start + (1 << 16)) + size - 1]
        powers, inverse = _power_tables((1 << 16) + size, base)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers[: len(part)], out=sums[1:])
        count = len(part) - size + 1
        out[start : start + count] = (sums[size:] - sums[:count]) * inverse[:count]
    return mix(out)


def word_arrays(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Like `texts_to_words` without translation, but no word becomes an object.

    Words are found as edges between white space and other bytes; a word's hash is the
    polynomial of its bytes, as a difference of running sums, mixed.
    """
    joined = np.frombuffer(b"\n".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[joined]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, stops = edges[0::2], edges[1::2]
    del space, edges
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(stops, low + _PIECE, "right")))
        size = int(stops[last - 1] - low)
        powers, inverse = _power_tables(max(size, _PIECE), BASES[0])
        sums = np.zeros(size + 1, np.uint64)
        letters = joined[low : low + size].astype(np.uint64)
        letters += np.uint64(1)  # so that a zero byte counts
        np.cumsum(letters * powers[:size], out=sums[1:])
        begin = starts[first:last] - low
        hashes[first:last] = (sums[stops[first:last] - low] - sums[begin]) * inverse[begin]
        first = last
    offsets = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return mix(hashes), np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all others (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, size: int, step: np.uint64 = _STEP) -> np.ndarray:
    """Hash of each run of `size` hashes, at the run's first place; those inside one array only."""
    n = max(0, len(hashes) - size + 1)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= step
        out += hashes[i : i + n]
    return mix(out)


def inside(ends: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of the first `n` places begin a run of `size` words that stays in its own text."""
    room = np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    lengths = np.diff(ends)
    for start, length in zip(ends[:-1], lengths, strict=True):
        if length >= size:
            room[start : start + length - size + 1] = True
    return room[:n]
