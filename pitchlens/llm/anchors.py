"""Content-defined anchors: which windows of a byte string share a minimizer.

Every window of ``length`` bytes holds ``length - gram + 1`` grams; its anchor
is the gram with the smallest hash, the leftmost of equals.  Equal windows
have equal anchors at equal offsets, wherever they stand, so windows can only
be equal if their anchors are.  Neighbouring windows mostly share an anchor
and form a *block*.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_CHUNK = 1 << 19  # window starts handled at once
_LOW = (1 << 20) - 1  # bits of a key that hold the gram's place in its chunk


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes."""
    n = len(raw)
    up, down = _powers(1 << max(16, (n + 1).bit_length()))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    return _mix((sums[gram:] - sums[:n + 1 - gram]) * down[:n + 1 - gram])


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    n = len(v)
    pad = -n % width
    a = np.concatenate((v, np.full(pad, np.iinfo(v.dtype).max, v.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(a, axis=1).ravel()
    back = np.minimum.accumulate(a[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def anchor_blocks(raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor place, anchor hash) of every block, in order."""
    windows = len(raw) - length + 1
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(0, windows), _CHUNK):
        part = raw[at:min(len(raw), at + _CHUNK + length - 1)]
        h = gram_hashes(part, gram)
        key = (h & ~np.uint64(_LOW)) | np.arange(len(h), dtype=np.uint64)
        least = sliding_min(key, length - gram + 1)
        first = np.flatnonzero(np.concatenate(([True], np.diff(least) != 0)))
        place = (least[first] & np.uint64(_LOW)).astype(np.int64)
        last = np.append(first[1:], len(least)) - 1
        out.append((first + at, last + at, place + at, h[place].view(np.int64)))
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))
