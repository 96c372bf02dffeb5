"""Words of UTF-8 bytes and their 64-bit hashes, whole arrays at a time."""

from __future__ import annotations

import numpy as np

#: bytes of words between white space (space and U+0009 to U+000D)
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: np.ndarray, word_byte: np.ndarray = NOT_SPACE,
                fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every run of word bytes; ``fold`` maps bytes first."""
    inside = word_byte[raw]
    edge = np.diff(inside.view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return start, end, np.zeros(0, np.uint64)
    length = end - start
    letters = raw[inside] if fold is None else fold[raw[inside]]
    letters = letters.astype(np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(len(letters)) - np.repeat(first, length)
    factors = mix(np.arange(int(length.max()), dtype=np.uint64))
    letters += np.uint64(1)
    letters *= factors[place]
    return start, end, mix(np.add.reduceat(letters, first) + length.astype(np.uint64))
