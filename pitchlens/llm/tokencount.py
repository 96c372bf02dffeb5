"""Token counts without tokens: a count-only Viterbi pass.

An Aho-Corasick automaton over the vocabulary lists, per marked word, every
vocabulary piece that occurs in it; dynamic programming over the word carries
two numbers per position, the best score and the number of pieces on the best
path.  Nothing is back-tracked and no piece list is built.  Ties follow the
tokenizer's rule (see ``pieces``): matches ending at one position are tried
from the earliest start and replace the best only if strictly better.

Words of a batch are counted once each; a bounded memo carries them from batch
to batch.  Map only, no shuffle.

Defined cases: a null or empty text has 0 tokens; a text of spaces has the
tokens of its marks; equal rows have equal counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pitchlens.llm.common import map_batches
from pitchlens.llm.pieces import DEFAULT_MODEL, Pieces, load_pieces, marked_words, utf8

MEMO_WORDS = 300_000  # distinct words a task remembers in each of two generations


@lru_cache(maxsize=4)
def automaton(path: str):
    import ahocorasick

    pieces = load_pieces(path)
    out = ahocorasick.Automaton()
    for text, score in pieces.scores.items():
        out.add_word(text, (len(text), score))
    out.make_automaton()
    return out


def count_word(word: str, matcher, pieces: Pieces) -> int:
    """Tokens of the best path through one marked word."""
    if not pieces.scores.keys() >= set(word):
        return _count_with_unknown(word, matcher, pieces)
    # every character is a piece, so every position is the end of a match
    best, count = [], []
    top, tokens, at = 0.0, 0, -1
    for end, (length, score) in matcher.iter(word):
        if end != at:
            best.append(top)
            count.append(tokens)
            top, tokens, at = best[end + 1 - length] + score, count[end + 1 - length] + 1, end
        else:  # longer matches, that is earlier starts, are reported first
            s = best[end + 1 - length] + score
            if s > top:
                top, tokens = s, count[end + 1 - length] + 1
    return tokens


def _count_with_unknown(word: str, matcher, pieces: Pieces) -> int:
    n = len(word)
    best, count = [0.0] * (n + 1), [0] * (n + 1)
    found: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for end, match in matcher.iter(word):
        found[end].append(match)
    for end in range(n):
        top, tokens = None, 0
        single = False
        for length, score in found[end]:
            s = best[end + 1 - length] + score
            single |= length == 1
            if top is None or s > top:
                top, tokens = s, count[end + 1 - length] + 1
        if not single:
            s = best[end] + pieces.unknown_score
            if top is None or s > top:
                top = s
                tokens = count[end] + (len(utf8(word[end])) if pieces.byte_ids else 1)
        best[end + 1], count[end + 1] = top, tokens
    return count[n]


def count_tokens(text: str, path: str = DEFAULT_MODEL) -> int:
    matcher, pieces = automaton(path), load_pieces(path)
    return sum(count_word(w, matcher, pieces) for w in marked_words(text))


def with_token_counts(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id, n_chars, n_marked_words, n_tokens (long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, pieces = automaton(model), load_pieces(model)
        memo: dict[str, int] = {}
        older: dict[str, int] = {}  # the generation before: what is still in use moves over
        for b in batches:
            texts = b.column(1).to_pylist()
            chars, n_words, tokens = [], [], []
            for text in texts:
                words = marked_words(text or "")
                if len(memo) > MEMO_WORDS:
                    memo, older = {}, memo
                for w in set(words).difference(memo):
                    c = older.get(w)
                    memo[w] = count_word(w, matcher, pieces) if c is None else c
                total = sum(map(memo.__getitem__, words))
                chars.append(len(text or ""))
                n_words.append(len(words))
                tokens.append(total)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(np.array(v, np.int64)) for v in (chars, n_words, tokens))],
                names=["doc_id", "n_chars", "n_marked_words", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), run,
                       f"doc_id {kind}, n_chars long, n_marked_words long, n_tokens long")
