"""Runs of periodic words, by recursive frequency splitting and a lag scan.

A *run* is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are equal), of at least ``max(LEAST, 2 * q)`` words, that no neighbouring word
extends.  Words are white-space separated, case and all.

1. *Splitting.*  A run holds at least two of each of its words, so a word that
   occurs once in a segment is in none of the segment's runs and splits it; parts
   of fewer than ``LEAST`` words go.  This recurses until every word of every
   segment occurs in it twice.  A word is alone in its segment when its previous
   and its next occurrence lie outside, so no counting is repeated: passes over
   the whole array while they remove a good share, then single cuts that look
   only at the smaller side of each cut (n log n in all).
2. *Lag scan* of what survives.  Lags below ``SHORT`` are compared whole.  A run of
   a longer period q, 2g <= q < 4g, repeats some aligned block of g words q words
   later; such blocks are found by the hashes of g word stretches, which double
   per level and drop every stretch that occurs once.  Each (block, lag) found is
   extended word by word in both directions.  Blocks inside one run of a period up
   to g are left out: the lag is then a multiple of that period.
3. A lag that is a multiple of a smaller period of its stretch is no smallest
   period and is dropped.

Hashes only propose lags; every reported word was compared.  All runs of a text
are found, however long the text is; memory is a few dozen bytes a word.

Defined cases: a null or empty text has no words and no runs, and collapses to the
empty text; rows that repeat are reported as often as they occur; an empty table
gives no rows; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitchlens.llm.common import map_batches
from pitchlens.llm.neardup import pieces
from pitchlens.llm.words import mix

LEAST = 12  # words of a run, at least
SHORT = 16  # lags below are compared whole; twice the first block, so a power of two
WORD = re.compile("[^\x20\x09-\x0d]+")
SPACE = re.compile("[\x20\x09-\x0d]")
CHUNK = 1 << 20  # characters whose words are held as strings at once


def chunks(text: str) -> Iterator[str]:
    """The text, cut at white space."""
    at = 0
    while len(text) - at > CHUNK:
        space = SPACE.search(text, at + CHUNK)
        if space is None:
            break
        yield text[at:space.start()]
        at = space.end()
    yield text[at:] if at else text


def numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(word numbers of all texts, each followed by a negative number of its own;
    where each text starts; the words by number)."""
    known: dict[str, int] = {}
    parts, starts, at = [], [], 0
    for k, text in enumerate(texts):
        starts.append(at)
        for chunk in chunks(text):
            words = WORD.findall(chunk)
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
            at += len(words)
        parts.append(np.array([-1 - k]))
        at += 1
    return np.concatenate(parts), np.array([*starts, at]), list(known)


def survivors(a: np.ndarray) -> np.ndarray:
    """Which words are left when splitting at words alone in their segment is stable."""
    n = len(a)
    at = np.arange(n)
    order = np.argsort(a, kind="stable")
    same = np.flatnonzero(a[order[1:]] == a[order[:-1]])
    before, after = np.full(n, -1), np.full(n, n)
    before[order[same + 1]], after[order[same]] = order[same], order[same + 1]
    alive = a >= 0
    while True:
        low = np.maximum.accumulate(np.where(alive, -1, at))
        high = np.minimum.accumulate(np.where(alive, n, at)[::-1])[::-1]
        alone = alive & (before <= low) & (after >= high)
        gone = alone | (alive & (high - low <= LEAST))
        if 16 * np.count_nonzero(gone) < np.count_nonzero(alive) or not gone.any():
            break
        alive &= ~gone
    todo = np.flatnonzero(alone).tolist()
    if todo:
        cuts = [-1, *np.flatnonzero(~alive).tolist(), n]
        while todo:
            x = todo.pop()
            if not alive[x]:
                continue
            alive[x] = False
            k = bisect_left(cuts, x)
            lo, hi = cuts[k - 1], cuts[k]
            insort(cuts, x)
            # the smaller side's words, and those of the other side they were the partners of
            if x - lo <= hi - x:
                small, own = at[lo + 1:x], (lo, x)
                lost = after[small]
                lost = lost[(lost > x) & (lost < hi)]
                lost = lost[after[lost] >= hi]
            else:
                small, own = at[x + 1:hi], (x, hi)
                lost = before[small]
                lost = lost[(lost > lo) & (lost < x)]
                lost = lost[before[lost] <= lo]
            todo += lost.tolist()
            if len(small) >= LEAST:
                todo += small[(before[small] <= own[0]) & (after[small] >= own[1])].tolist()
        low = np.maximum.accumulate(np.where(alive, -1, at))
        high = np.minimum.accumulate(np.where(alive, n, at)[::-1])[::-1]
    return alive & (high - low > LEAST)


def primitive(v: np.ndarray, start: int, q: int) -> bool:
    """Whether q is the smallest period of the stretch of 2q words or more at ``start``."""
    rest, p = q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            d = q // p
            if np.array_equal(v[start:start + q], v[start + d:start + d + q]):
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


def extended(v: np.ndarray, j: int, q: int) -> tuple[int, int]:
    """[s, e) around j, as wide as v[i] == v[i + q] holds; empty if it doesn't at j."""
    e, step = j, 64
    while e < len(v) - q:
        x = v[e:min(e + step, len(v) - q)]
        unlike = x != v[e + q:e + q + len(x)]
        first = int(unlike.argmax())
        if unlike[first]:
            e += first
            break
        e, step = e + len(x), 2 * step
    s, step = j, 64
    while s > 0 and e > j:
        x = v[max(0, s - step):s]
        unlike = (x != v[s - len(x) + q:s + q])[::-1]
        first = int(unlike.argmax())
        if unlike[first]:
            s -= first
            break
        s, step = s - len(x), 2 * step
    return s, e


def scanned(v: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``v``."""
    n = len(v)
    out: list[tuple[int, int, int]] = []
    for q in range(1, min(SHORT, n // 2 + 1)):
        edges = np.concatenate(([-1], np.flatnonzero(v[q:] != v[:-q]), [n - q]))
        length = np.diff(edges) - 1
        for k in np.flatnonzero(length >= max(LEAST, 2 * q) - q).tolist():
            start = int(edges[k]) + 1
            if primitive(v, start, q):
                out.append((start, int(length[k]) + q, q))

    g = 1
    h = mix(v.view(np.uint64))
    at = np.arange(n)
    table, some = np.zeros(n, np.uint64), np.zeros(n, bool)
    while 4 * g <= n and len(at):
        if 2 * g >= SHORT:
            # stretches of g words that occur twice or more, by stretch and place
            order = np.argsort(h, kind="stable")
            h, at = h[order], at[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            twice = ~(new & np.append(new[1:], True))
            h, at, group = h[twice], at[twice], np.cumsum(new)[twice]
            out += long_runs(v, g, at, group, out)
        some[:] = False
        some[at], table[at] = True, h
        at = np.sort(at)
        at = at[at < n - g]
        at = at[some[at + g]]
        h = mix(table[at] * np.uint64(0x9E3779B97F4A7C15) + table[at + g])
        g *= 2
    return out


def long_runs(v: np.ndarray, g: int, at: np.ndarray, group: np.ndarray,
              known: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The runs of periods from 2g to 4g, from stretches of g words that recur;
    ``known`` are those of smaller periods."""
    n = len(v)
    key = group * (n + 1) + at
    blocks = np.flatnonzero(at % g == 0)
    first = np.searchsorted(key, group[blocks] * (n + 1) + np.minimum(at[blocks] + 2 * g, n))
    last = np.searchsorted(key, group[blocks] * (n + 1) + np.minimum(at[blocks] + 4 * g, n))
    many = last - first
    j = np.repeat(at[blocks], many)
    met = np.arange(len(j)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    lag = at[met] - j
    inner = sorted((s, s + length) for s, length, q in known if q <= g)
    if inner and len(j):
        starts, ends = np.array(inner).T
        k = np.searchsorted(starts, j, "right") - 1
        inside = (k >= 0) & (np.maximum.accumulate(ends)[k] >= j + lag + g)
        j, lag = j[~inside], lag[~inside]
    out = []
    order = np.lexsort((j, lag))
    q = end = -1
    for i, x in zip(j[order].tolist(), lag[order].tolist(), strict=True):
        if x == q and i < end:
            continue
        q = x
        start, end = extended(v, i, q)
        if end - start >= q and 2 * q >= LEAST and primitive(v, start, q):
            out.append((start, end - start + q, q))
    return out


def runs(a: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period, of word numbers;
    negative numbers, each used once, are borders no run crosses."""
    at = np.flatnonzero(survivors(a))
    if not len(at):
        return np.zeros((0, 3), np.int64)
    border = np.flatnonzero(np.diff(at) > 1) + 1
    # borders between segments; the numbers of ``a`` needn't be unlike them, only used nowhere else
    v = np.insert(a[at], border, -1 - len(a) - np.arange(len(border)))
    found = np.array(scanned(v), np.int64).reshape(-1, 3)
    found[:, 0] = np.insert(at, border, -1)[found[:, 0]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def dropped(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words some run contains after that run's first period."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, found[:, 0] + found[:, 2], 1)
    np.add.at(step, found[:, 0] + found[:, 1], -1)
    return np.cumsum(step[:-1]) > 0


def joined(numbers: np.ndarray, words: list[str]) -> str:
    return " ".join(" ".join(map(words.__getitem__, numbers[k:k + CHUNK].tolist())) for k in range(0, len(numbers), CHUNK))


def text_runs(texts: list[str]) -> Iterator[tuple[int, np.ndarray, str]]:
    """Per text: its number of words, its runs and its words outside repeated periods."""
    a, starts, words = numbered(texts)
    found = runs(a)
    keep = ~dropped(len(a), found)
    edge = np.searchsorted(found[:, 0], starts)
    for k, (lo, hi) in enumerate(zip(starts[:-1].tolist(), (starts[1:] - 1).tolist(), strict=True)):
        yield hi - lo, found[edge[k]:edge[k + 1]] - [lo, 0, 0], joined(a[lo:hi][keep[lo:hi]], words)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, runs (start in words, length, period; by start and
    period) and collapsed (the words that no run contains after its first period,
    with single spaces)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    triple = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, part in pieces(b.column(1).to_pylist()):
                n, found, collapsed = zip(*text_runs(part), strict=True)
                rows = np.concatenate(found)
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                flat = pa.StructArray.from_arrays([pa.array(rows[:, c], pa.int64()) for c in range(3)], fields=list(triple))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(part)), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, flat), pa.array(collapsed, pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])

    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
