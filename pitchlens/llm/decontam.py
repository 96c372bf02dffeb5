"""Benchmark decontamination with an FM-index per training shard.

A shard is a batch of documents.  Its words are mapped to the numbers of the
test phrases' words; a word that no phrase has can't be part of an occurrence,
so the shard's text is the runs of phrase words at least as long as the
shortest phrase, with separators between them.  Over that text a suffix array,
its Burrows-Wheeler transform and a wavelet matrix are built.  All phrases are
searched backward at once by wavelet ranks, their occurrences are located by
walking to sampled suffix positions, and overlapping occurrences merge into
removal spans.

The phrases are the windows of ``WINDOW`` consecutive words of each item; an
item of fewer words, but not none, is one phrase.  Items are taken in blocks
of about ``BLOCK_BYTES``: a larger benchmark costs more passes over the
documents, never more memory.

Words are compared by 64-bit hashes.  Map only: no document is shuffled.

Defined cases: null and empty texts have no words; an item without words
matches nothing; equal items are all reported; an empty benchmark leaves every
document clean; further columns are carried by ``clean`` whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.llm import words
from pitchlens.llm.common import map_batches

WINDOW = 10
BLOCK_BYTES = 32 << 20
PIECE_BYTES = 4 << 20  # texts are split into words in pieces of about this size
SAMPLE = 8  # every so many text positions the suffix array is kept

_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[0x30:0x3A] = _WORD_BYTE[0x41:0x5B] = _WORD_BYTE[0x61:0x7B] = _WORD_BYTE[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, 64-bit hash) of every word of some UTF-8 bytes, A-Z as a-z."""
    return words.word_hashes(raw, _WORD_BYTE, _LOWER)


@dataclass(frozen=True)
class Phrases:
    """Phrases as rows of word numbers (1..), right-aligned and padded with 0 on the left."""

    vocabulary: np.ndarray  # sorted word hashes
    filter: np.ndarray  # by the low 20 bits of a hash: whether any vocabulary word has them
    words: np.ndarray  # (phrases, WINDOW)
    lengths: np.ndarray
    items: list[list[str]]  # of each phrase

    @property
    def shortest(self) -> int:
        return int(self.lengths.min()) if len(self.lengths) else 0


def phrases_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> Phrases:
    by_phrase: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, text in items:
        h = word_hashes(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))[2].tolist()
        if h:
            for k in range(max(1, len(h) - window + 1)):
                by_phrase[tuple(h[k:k + window])].add(item)
    vocabulary = np.array(sorted({w for p in by_phrase for w in p}), np.uint64)
    rows = np.zeros((len(by_phrase), window), np.int64)
    for row, p in enumerate(by_phrase):
        rows[row, window - len(p):] = np.searchsorted(vocabulary, np.array(p, np.uint64)) + 1
    sieve = np.zeros(1 << 20, bool)
    sieve[(vocabulary & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    return Phrases(vocabulary, sieve, rows, (rows > 0).sum(1), [sorted(s) for s in by_phrase.values()])


def numbered(hashes: np.ndarray, p: Phrases) -> np.ndarray:
    """Word numbers, 0 for words that no phrase has."""
    out = np.zeros(len(hashes), np.int64)
    maybe = np.flatnonzero(p.filter[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
    at = np.searchsorted(p.vocabulary, hashes[maybe])
    at[at == len(p.vocabulary)] = 0
    known = p.vocabulary[at] == hashes[maybe]
    out[maybe[known]] = at[known] + 1
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling; the end of the text sorts first."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    n, step = len(text), 1
    while True:
        key = rank * (n + 2)
        key[:n - step] += rank[step:] if step < n else 0
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate(([1], np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n:
            return order
        step *= 2


class FMIndex:
    """Backward search over a text of small numbers that ends with its only 0."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        order = suffix_array(text)
        self.n = len(text)
        bwt = text[order - 1]
        top = int(text.max()) + 1
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top))))
        self.levels: list[tuple[int, np.ndarray, int]] = []  # (bit, ones before each place, zeros)
        for bit in range(max(1, top.bit_length()) - 1, -1, -1):
            ones = (bwt >> bit) & 1
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), int(len(ones) - ones.sum())))
            bwt = np.concatenate((bwt[ones == 0], bwt[ones == 1]))
        self.marked = np.full(self.n, -1, np.int64)
        kept = order % sample == 0
        self.marked[kept] = order[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands in the transform before place ``at``."""
        low = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            at = np.where(one, zeros + ones[at], at - ones[at])
            low = np.where(one, zeros + ones[low], low - ones[low])
        return at - low

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            one = ones[at + 1] - ones[at]
            out |= one << bit
            at = np.where(one == 1, zeros + ones[at], at - ones[at])
        return out

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, low, high): the non-empty intervals of right-aligned phrases."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[which, k]
            step = symbol > 0
            s = symbol[step]
            known = np.minimum(s, len(self.before) - 2)
            low[step] = self.before[known] + self.rank(s, low[step])
            high[step] = self.before[known] + self.rank(s, high[step])
            high[step] = np.where(known == s, high[step], low[step])
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        out = np.zeros(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            found = self.marked[rows]
            done = found >= 0
            out[open_[done]] = found[done] + steps
            open_, rows = open_[~done], rows[~done]
            if len(rows):
                s = self.symbol(rows)
                rows = self.before[s] + self.rank(s, rows)
            steps += 1
        return out


def shard_words(texts: list[bytes], p: Phrases) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Word counts of the texts, and of each phrase word: document, ordinal in it, number, bytes."""
    counts = np.zeros(len(texts), np.int64)
    parts: dict[str, list[np.ndarray]] = defaultdict(list)

    def take(raw: bytes, docs: np.ndarray, offsets: np.ndarray) -> None:
        """``raw``: pieces of the given documents, each from the given byte on, 0 between them."""
        a = np.frombuffer(raw, np.uint8)
        start, end, h = word_hashes(a)
        lengths = np.diff(np.append(offsets[1], len(a) + 1))
        piece = np.repeat(np.arange(len(docs)), lengths)[start] if len(start) else start
        n = np.bincount(piece, minlength=len(docs))
        ordinal = np.arange(len(start)) - np.repeat(np.cumsum(n) - n, n) + counts[docs][piece]
        number = numbered(h, p)
        keep = number > 0
        shift = (offsets[0] - offsets[1])[piece[keep]]
        for name, v in (("doc", docs[piece[keep]]), ("word", ordinal[keep]), ("number", number[keep]),
                        ("start", start[keep] + shift), ("end", end[keep] + shift)):
            parts[name].append(v)
        np.add.at(counts, docs, n)

    held: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            at = np.cumsum([0] + [len(texts[i]) + 1 for i in held[:-1]])
            take(b"\0".join(texts[i] for i in held), np.array(held), np.array([np.zeros_like(at), at]))
        held, size = [], 0

    for i, text in enumerate(texts):
        if len(text) <= PIECE_BYTES:
            held.append(i)
            size += len(text) + 1
            if size >= PIECE_BYTES:
                flush()
            continue
        flush()
        at = 0
        while at < len(text):  # a long text, cut where no word is cut
            end = min(len(text), at + PIECE_BYTES)
            while end < len(text) and _WORD_BYTE[text[end]]:
                end += 1
            take(text[at:end], np.array([i]), np.array([[at], [0]]))
            at = end
    flush()
    return counts, {k: np.concatenate(v) for k, v in parts.items()}


def shard_hits(texts: list[bytes], p: Phrases) -> tuple[np.ndarray, list[list[tuple[int, int, int, int]]], list[set[str]]]:
    """Per document: words, merged spans (first word, word after, first byte, byte after) and items found."""
    spans: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    counts, w = shard_words(texts, p)
    if not len(p.lengths) or not w or not len(w["doc"]):
        return counts, spans, items
    # runs of neighbouring phrase words, at least as long as the shortest phrase
    new = np.concatenate(([True], (np.diff(w["doc"]) != 0) | (np.diff(w["word"]) != 1)))
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(new)))
    long_ = length >= p.shortest
    first, length = first[long_], length[long_]
    if not len(first):
        return counts, spans, items
    total = int(length.sum()) + len(length)
    place = np.cumsum(length + 1) - length - 1  # of each run in the text; a 0 follows it
    source = np.full(total, -1, np.int64)
    inside = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    source[np.repeat(place, length) + inside] = np.repeat(first, length) + inside
    # in the index's text 0 is its end, 1 a separator and words count from 2
    index = FMIndex(np.append(np.where(source >= 0, w["number"][source], 0) + 1, 0))
    which, low, high = index.search(np.where(p.words > 0, p.words + 1, 0))
    if not len(which):
        return counts, spans, items
    n = high - low
    rows = np.repeat(low, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    phrase = np.repeat(which, n)
    at = source[index.locate(rows)]
    for d, q in {*zip(w["doc"][at].tolist(), phrase.tolist(), strict=True)}:
        items[d].update(p.items[q])
    hit = np.zeros(len(new) + 1, np.int64)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + p.lengths[phrase], -1)
    inside = np.cumsum(hit[:-1]) > 0
    begin = inside & (new | ~np.concatenate(([False], inside[:-1])))
    end = inside & np.concatenate((new[1:], [True])) | inside & ~np.concatenate((inside[1:], [False]))
    b, e = np.flatnonzero(begin), np.flatnonzero(end)
    for d, *span in zip(w["doc"][b].tolist(), w["word"][b].tolist(), (w["word"][e] + 1).tolist(),
                        w["start"][b].tolist(), w["end"][e].tolist(), strict=True):
        spans[d].append(tuple(span))
    return counts, spans, items


def merged(a: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    out: list[tuple[int, int, int, int]] = []
    for s in sorted(a):
        if out and s[0] <= out[-1][1]:
            last = out[-1]
            out[-1] = (last[0], max(last[1], s[1]), last[2], max(last[3], s[3]))
        else:
            out.append(s)
    return out


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[Phrases]:
    """The benchmark's phrases in blocks of about ``block_bytes`` of text, by item hash."""
    total = benchmark.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    keyed = benchmark.select(F.col("item_id").cast("string").alias("item"), "text",
                             F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).alias("block"))
    return [phrases_of([(r["item"] or "", r["text"]) for r in keyed.where(F.col("block") == k).collect()], window)
            for k in range(n)]


SPAN = "array<struct<first_word:bigint,after_word:bigint,first_byte:bigint,after_byte:bigint>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """``row`` (the whole input row), n_words, spans (merged occurrences, word and
    UTF-8 byte positions) and items.  With ``cut`` the row's text has the spans
    cut out, until the shortened text has no occurrence either."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    kind = packed.schema["row"].dataType.simpleString()
    schema = f"row {kind}, n_words long, spans {SPAN}, items array<string>"
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in phrase_blocks(benchmark, window, block_bytes)]

    def run_block(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            p = block.value
            for b in batches:
                rows = b.column(0)
                at = rows.type.get_field_index("text")
                texts = [(t or "").encode("utf-8", "replace") for t in rows.field(at).to_pylist()]
                counts, spans, items = shard_hits(texts, p)
                if b.num_columns > 1:  # what earlier blocks found
                    spans = [merged([*new, *(tuple(s.values()) for s in old)])
                             for new, old in zip(spans, b.column(2).to_pylist(), strict=True)]
                    items = [new.union(old) for new, old in zip(items, b.column(3).to_pylist(), strict=True)]
                names = ["first_word", "after_word", "first_byte", "after_byte"]
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(counts, pa.int64()),
                     pa.array([[dict(zip(names, s, strict=True)) for s in a] for a in spans],
                              pa.list_(pa.struct([(k, pa.int64()) for k in names]))),
                     pa.array([sorted(s) for s in items], pa.list_(pa.string()))],
                    names=["row", "n_words", "spans", "items"])
        return run

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0)
            at = rows.type.get_field_index("text")
            texts = rows.field(at).to_pylist()
            spans = [[tuple(s.values()) for s in a] for a in b.column(2).to_pylist()]
            counts = b.column(1).to_pylist()
            todo = [i for i, s in enumerate(spans) if s]
            while todo:
                left = []
                for i in todo:
                    raw = texts[i].encode("utf-8", "replace")
                    texts[i] = without(raw, spans[i]).decode("utf-8", "replace")
                    counts[i] -= sum(s[1] - s[0] for s in spans[i])
                    left.append(texts[i].encode("utf-8", "replace"))
                found = [merged([s for block in per for s in block])
                         for per in zip(*(shard_hits(left, p.value)[1] for p in blocks), strict=True)]
                for i, s in zip(todo, found, strict=True):
                    spans[i] = s
                todo = [i for i in todo if spans[i]]
            fields = [pa.array(texts, rows.type[k].type) if k == at else rows.field(k) for k in range(rows.type.num_fields)]
            new = pa.StructArray.from_arrays(fields, fields=[rows.type[k] for k in range(rows.type.num_fields)])
            yield pa.RecordBatch.from_arrays([new, pa.array(counts, pa.int64()), b.column(2), b.column(3)],
                                             names=["row", "n_words", "spans", "items"])

    out = reduce(lambda df, block: map_batches(df, run_block(block), schema), blocks, packed)
    return map_batches(out, cut_out, schema) if cut else out


def without(raw: bytes, spans: list[tuple[int, int, int, int]]) -> bytes:
    """The text without the spans' bytes."""
    out, at = [], 0
    for _, _, first, after in spans:
        out.append(raw[at:first])
        at = after
    return b"".join([*out, raw[at:]])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark passages, with the columns of ``docs``
    (``n_chars``, where there is one, is that of the new text); a document that
    was nothing but such passages goes."""
    found = find_contamination(docs, benchmark, cut=True).where("size(spans) = 0 or n_words > 0")
    cols = []
    for f in docs.schema.fields:
        c = F.col("row").getField(f.name)
        if f.name == "n_chars":
            c = F.when(F.size("spans") > 0, F.char_length(F.col("row.text"))).otherwise(c).cast(f.dataType)
        cols.append(c.alias(f.name))
    return found.select(*cols)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, words hit, items found and their digest."""
    found = find_contamination(docs, benchmark)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["after_word"] - s["first_word"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
