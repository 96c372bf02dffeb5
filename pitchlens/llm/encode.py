"""Subword encoding and decoding by a shared-prefix Viterbi pass.

The distinct marked words of a batch are sorted, which lays them out as the
depth-first order of their trie.  The traversal keeps one forward state per
depth (best score of the prefix, where its last piece starts, and the
vocabulary nodes that are still open); going to the next word pops back to the
common prefix and extends from there, so a prefix's scores are computed once
for all words that share it.  Scores and ties are those of ``pieces``.

Decoding maps ids back to pieces, joins byte pieces as UTF-8, turns marks into
spaces and drops the mark put in front: ``decode(encode(t)) == t`` for every
text without a literal U+2581 or lone surrogates, which read as a space and
U+FFFD.

Map only, no shuffle.  Defined cases: null and empty texts have no ids and
decode to the empty text; equal rows have equal ids.
"""

from __future__ import annotations

import hashlib
import struct
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitchlens.llm.common import map_batches
from pitchlens.llm.pieces import DEFAULT_MODEL, MARK, Pieces, load_pieces, marked, marked_words, utf8

MEMO_WORDS = 300_000  # distinct words a task remembers in each of two generations


@lru_cache(maxsize=4)
def vocabulary_trie(path: str) -> dict:
    """Nested dicts by character; the key '' holds (id, score)."""
    pieces = load_pieces(path)
    root: dict = {}
    for text, score in pieces.scores.items():
        node = root
        for ch in text:
            node = node.setdefault(ch, {})
        node[""] = (pieces.ids[text], score)
    return root


def encode_sorted(words: Iterable[str], root: dict, pieces: Pieces) -> Iterator[tuple[str, list[int]]]:
    """(word, ids) for marked words in sorted order."""
    # per depth: best score, start of the last piece, its id (-1: unknown character), open nodes;
    # nodes are kept only as deep as the next word shares them
    score, start, last, open_at = array("d", [0.0]), array("q", [0]), array("i", [-1]), [[]]
    depth = 0
    for word, after in pairwise(chain(words, [""])):
        shared = 0
        for a, b in zip(word, after, strict=False):
            if a != b:
                break
            shared += 1
        for state in (score, start, last, open_at):
            del state[depth + 1:]
        opened = open_at[depth]
        for end in range(depth, len(word)):
            ch = word[end]
            top, top_start, top_id, single = None, end, -1, False
            still = []
            # open nodes are kept by start, earliest first; the one that starts here comes last
            for s, node in opened:
                child = node.get(ch)
                if child is not None:
                    still.append((s, child))
                    piece = child.get("")
                    if piece is not None:
                        v = score[s] + piece[1]
                        if top is None or v > top:
                            top, top_start, top_id = v, s, piece[0]
            child = root.get(ch)
            if child is not None:
                still.append((end, child))
                piece = child.get("")
                if piece is not None:
                    single = True
                    v = score[end] + piece[1]
                    if top is None or v > top:
                        top, top_start, top_id = v, end, piece[0]
            if not single:
                v = score[end] + pieces.unknown_score
                if top is None or v > top:
                    top, top_start, top_id = v, end, -1
            score.append(top)
            start.append(top_start)
            last.append(top_id)
            opened = still
            if end < shared:
                open_at.append(still)
        ids: list[int] = []
        at = len(word)
        while at:
            s = start[at]
            if last[at] >= 0:
                ids.append(last[at])
            elif pieces.byte_ids:
                ids.extend(pieces.byte_ids[x] for x in reversed(utf8(word[s:at])))
            else:
                ids.append(pieces.unknown_id)
            at = s
        yield word, ids[::-1]
        depth = shared


def encode_text(text: str, path: str = DEFAULT_MODEL) -> list[int]:
    root, pieces = vocabulary_trie(path), load_pieces(path)
    words = marked_words(text)
    by_word = dict(encode_sorted(sorted(set(words)), root, pieces))
    return [i for w in words for i in by_word[w]]


@lru_cache(maxsize=4)
def _piece_bytes(path: str) -> tuple[bytes, ...]:
    pieces = load_pieces(path)
    single = {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}
    return tuple(single.get(i) or t.replace(MARK, " ").encode() for i, t in enumerate(pieces.texts))


def decode_ids(ids: Iterable[int], path: str = DEFAULT_MODEL) -> str:
    table = _piece_bytes(path)
    raw = b"".join([table[i] for i in ids])
    return raw[1:].decode("utf-8", "replace")  # without the mark put in front


class WordIds:
    """Ids of marked words, each distinct word encoded once, as little-endian
    32-bit numbers; two generations of at most about ``MEMO_WORDS`` words."""

    def __init__(self, path: str):
        self.root, self.pieces = vocabulary_trie(path), load_pieces(path)
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > MEMO_WORDS:
            self.ids, self.older = {}, self.ids
        new = words.difference(self.ids)
        for word in new & self.older.keys():
            self.ids[word] = self.older[word]
        for word, ids in encode_sorted(sorted(new.difference(self.older)), self.root, self.pieces):
            self.ids[word] = struct.pack(f"<{len(ids)}i", *ids)

    def of(self, words: list[str]) -> bytes:
        return b"".join(map(self.ids.__getitem__, words))


def encoded(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, ids (array of int), n_tokens, ids_sha256 (of the ids as little-endian
    32-bit numbers), text_sha256 (of the decoded text) and round_trip (the decoded
    text has the marked form of the source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordIds(model)
        for b in batches:
            ids, n, ids_sha, text_sha, same = [], [], [], [], []
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):  # a few texts at a time: their distinct words are sorted together
                part, size = [], 0
                while at < len(texts) and size < 2_000_000:
                    part.append(texts[at] or "")
                    size += len(part[-1])
                    at += 1
                split = [marked_words(t) for t in part]
                memo.learn(set().union(*map(set, split)))
                for text, words in zip(part, split, strict=True):
                    raw = memo.of(words)
                    a = np.frombuffer(raw, "<i4")
                    back = decode_ids(a.tolist(), model)
                    ids.append(a)
                    n.append(len(a))
                    ids_sha.append(hashlib.sha256(raw).hexdigest())
                    text_sha.append(hashlib.sha256(back.encode()).hexdigest())
                    same.append(back == text or marked(back) == marked(text))
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))), pa.array(n, pa.int64()),
                 pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string()), pa.array(same, pa.bool_())],
                names=["doc_id", "ids", "n_tokens", "ids_sha256", "text_sha256", "round_trip"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", "text"), run,
        f"doc_id {kind}, ids array<int>, n_tokens long, ids_sha256 string, text_sha256 string, round_trip boolean")
