"""Exact removal of long repeated byte strings by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that also starts at
another place, in the same document or another; matches never cross documents.

1. Windows of ``length`` bytes are grouped by their anchor gram (``anchors``).
   Anchors that occur once can't hold a repeat; only the others go on.
2. Blocks (neighbouring windows of one anchor, with their bytes) that are equal
   as a whole repeat as a whole: one aggregation over (anchor, digest), which
   combines map-side, so a passage in a third of all documents costs a row per
   map task.  One block of each kind represents it from here on.
3. Blocks that share an anchor but differ - the edges of repeats - meet in
   groups by anchor.  Many groups are packed into one text, its suffix array
   is built, and longest-previous-factor values of the windows follow from the
   previous and next smaller positions in suffix order: a window has an
   earlier copy if its factor reaches ``length``.  The mirrored array over
   greater positions gives later copies.
4. An anchor with more than ``GROUP`` different blocks isn't gathered: its
   blocks are split into single windows, and equal windows meet by digest.

``keep="first"`` removes later copies and keeps the first occurrence (order:
doc_id, text hash, position); ``keep="none"`` removes every occurrence.

Lost executors: the steps are cut by written tables in the shared folder.

Defined cases: null and empty texts have no bytes; texts under ``length``
bytes lose nothing; rows equal in doc_id and text are occurrences of their own
and share one result; an empty table gives no rows; further columns are
carried by ``deduplicated`` whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.anchors import anchor_blocks
from pitchlens.llm.common import doc_key, map_batches, stored

LENGTH = 400
GRAM = 200
GROUP = 512  # different blocks of one anchor that meet in one suffix array, at most
SUFFIX_BYTES = 1 << 20  # groups are packed into texts of about this size


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(doc_key().alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"))


def _blocks(docs: DataFrame, length: int, gram: int, full: bool) -> DataFrame:
    """The blocks of all documents: only their anchor hash, or with key, place and digest."""
    keyed = _keyed(docs).where(F.octet_length("raw") >= length)
    kind = keyed.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            keys, raws = b.column(0), b.column(1)
            parts, row, digests = [], [], []
            for i in range(b.num_rows):
                buf = raws[i].as_buffer()
                first, last, _, h = anchor_blocks(np.frombuffer(buf, np.uint8), length, gram)
                parts.append((first, last, h))
                if full:
                    view = memoryview(buf)
                    row.append(np.full(len(first), i))
                    digests.extend([digest(view[x:y]) for x, y in zip(first.tolist(), (last + length).tolist(), strict=True)])
            if not parts:
                continue
            first, last, h = (np.concatenate(c) for c in zip(*parts, strict=True))
            if not full:
                yield pa.RecordBatch.from_arrays([pa.array(h)], names=["anchor"])
                continue
            rows = np.concatenate(row)
            for at in range(0, len(h), 50_000):
                cut = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[cut]), pa.array(digests[cut], pa.binary()), keys.take(pa.array(rows[cut])),
                     pa.array(first[cut]), pa.array(last[cut])],
                    names=["anchor", "digest", "key", "first", "last"])

    return map_batches(keyed, run, f"anchor long, digest binary, key {kind}, first long, last long" if full
                       else "anchor long", batch_rows=500)


def has_earlier(order: np.ndarray, run: np.ndarray) -> np.ndarray:
    """Of suffixes in suffix order, in runs that agree on the whole length: whether
    the previous or the next smaller position lies in the run, that is whether the
    longest previous factor reaches the length."""
    big = np.int64(len(order) + 1)
    rank = np.empty(len(order), np.int64)
    rank[np.argsort(order, kind="stable")] = np.arange(len(order))
    # running minima that start anew in each run: earlier runs lie above later ones
    shifted = rank - run * big
    before = np.minimum.accumulate(shifted)
    previous = np.concatenate(([False], (before[:-1] < shifted[1:]) & (run[1:] == run[:-1])))
    back = (rank + run * big)[::-1]
    after = np.minimum.accumulate(back)[::-1]
    following = np.concatenate((after[1:] < (rank + run * big)[:-1], [False])) & np.concatenate((run[1:] == run[:-1], [False]))
    return previous | following


def repeated_windows(contexts: list[bytes], starts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the first ``starts[i]`` windows of each context, in the contexts' order:
    (context, earlier copy, later copy) flags by a suffix array of all contexts."""
    sizes = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(contexts), np.uint8)
    n = len(text)
    base = np.cumsum(sizes) - sizes
    starts = np.array(starts)
    context = np.repeat(np.arange(len(contexts)), starts)
    place = np.repeat(base, starts) + np.arange(len(context)) - np.repeat(np.cumsum(starts) - starts, starts)
    # ranks of all strings of 1, 2, 4, .. bytes, to the largest power within the length
    # (strings that run on past their context only belong to no window)
    rank, step = text.astype(np.int64), 1
    while step * 2 <= length:
        key = rank * (int(rank.max()) + 2)
        key[:n - step] += rank[step:] + 1
        if step < 4:  # up to 8 bytes the key itself is small enough to rank by
            rank = key if step * 2 < 4 else np.unique(key, return_inverse=True)[1]
        else:
            rank = np.unique(key, return_inverse=True)[1]
        rank = rank.astype(np.int64)
        step *= 2
    a, b = rank[place], rank[place + length - step]
    key = a * (int(rank.max()) + 1) + b
    suffix_order = np.argsort(key, kind="stable")
    run = np.cumsum(np.concatenate(([0], np.diff(key[suffix_order]) != 0)))
    earlier, later = np.zeros(len(place), bool), np.zeros(len(place), bool)
    earlier[suffix_order] = has_earlier(place[suffix_order], run)
    later[suffix_order] = has_earlier(-place[suffix_order], run)
    return context, earlier, later


def _spans(first: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Sorted window starts as merged byte spans."""
    if not len(first):
        return []
    cut = np.flatnonzero(np.diff(first) > length)
    return list(zip(first[np.concatenate(([0], cut + 1))].tolist(),
                    (first[np.append(cut, len(first) - 1)] + length).tolist(), strict=True))


def repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int | None = None,
            group: int = GROUP) -> DataFrame:
    """Documents that lose bytes: key, raw (the text's bytes) and spans (sorted, may touch)."""
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    gram = gram or max(1, length // 2)
    # stored, so that both sides of the join are plain shuffles, which split where an anchor is hot
    shared = stored(_blocks(docs, length, gram, False).groupBy("anchor").count().where("count > 1").select("anchor"),
                    "repeat-anchors")
    blocks = stored(_blocks(docs, length, gram, True).join(shared, "anchor", "left_semi"), "repeat-blocks")
    kinds = stored(blocks.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "first", "last")).alias("rep")), "repeat-kinds")
    several = stored(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"), "repeat-several")
    whole = blocks.join(kinds.where("n > 1").select("anchor", "digest", "rep"), ["anchor", "digest"])
    if keep == "first":
        whole = whole.where(~((F.col("key") == F.col("rep.key")) & (F.col("first") == F.col("rep.first"))))
    null = lambda kind: F.lit(None).cast(kind)
    info = (whole.select("key", "first", "last", null("long").alias("anchor"), null("long").alias("n"), null("long").alias("kinds"))
            .unionByName(kinds.join(several, "anchor").select("rep.key", "rep.first", "rep.last", "anchor", "n", "kinds"))
            .groupBy("key").agg(F.collect_list(F.struct("first", "last", "anchor", "n", "kinds")).alias("blocks")))
    touched = stored(_keyed(docs).join(info, "key").dropDuplicates(["key"]), "repeat-texts")
    fine = _fine(touched, length, keep, group)
    spans = F.concat(
        F.transform(F.filter("blocks", lambda x: x["anchor"].isNull()),
                    lambda x: F.struct(x["first"].alias("first"), (x["last"] + length).alias("after"))),
        F.coalesce("fine", F.array().cast("array<struct<first:bigint,after:bigint>>")))
    return (touched.join(fine.groupBy("key").agg(F.collect_list(F.struct("first", "after")).alias("fine")), "key", "left")
            .select("key", "raw", F.array_sort(spans).alias("spans")).where(F.size("spans") > 0))


def _fine(touched: DataFrame, length: int, keep: str, group: int) -> DataFrame:
    """key, first, after: repeats found between blocks that share an anchor but differ."""
    kind = touched.schema["key"].dataType.simpleString()

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in batches:
            out: list[tuple] = []
            for i, (raw, blocks) in enumerate(zip(b.column(1), b.column(2).to_pylist(), strict=True)):
                view = memoryview(raw.as_buffer())
                for x in blocks:
                    if x["anchor"] is None:
                        continue
                    if x["kinds"] <= group:
                        out.append((x["anchor"], i, x["first"], x["last"], x["n"], bytes(view[x["first"]:x["last"] + length]), None))
                    else:
                        out.extend((x["anchor"], i, k, k, x["n"], None, digest(view[k:k + length]))
                                   for k in range(x["first"], x["last"] + 1))
            for at in range(0, len(out), 10_000):
                anchor, row, first, last, n, raw, window = zip(*out[at:at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor, pa.int64()), b.column(0).take(pa.array(row)), pa.array(first, pa.int64()),
                     pa.array(last, pa.int64()), pa.array(n, pa.int64()), pa.array(raw, pa.binary()), pa.array(window, pa.binary())],
                    names=["anchor", "key", "first", "last", "n", "raw", "window"])

    rows = stored(map_batches(
        touched.select("key", "raw", "blocks").where(F.exists("blocks", lambda x: x["anchor"].isNotNull())), contexts,
        f"anchor long, key {kind}, first long, last long, n long, raw binary, window binary", batch_rows=200), "repeat-edges")

    def order(key: dict, first: int) -> tuple:
        return key["id"] is not None, key["id"] if key["id"] is not None else 0, key["h"], first

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0

        def found() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda r: order(r["key"], r["first"]))
            context, earlier, later = repeated_windows(
                [r["raw"] for r in held], [r["last"] - r["first"] + 1 for r in held], length)
            hit = earlier if keep == "first" else earlier | later
            ends = np.cumsum(np.bincount(context, minlength=len(held)))
            out = []
            for r, flags in zip(held, np.split(hit, ends[:-1]), strict=True):
                out.extend((r["key"], r["first"] + x, r["first"] + y) for x, y in _spans(np.flatnonzero(flags), length))
            if out:
                key, first, after = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(key, batch_key), pa.array(first, pa.int64()), pa.array(after, pa.int64())],
                                                 names=["key", "first", "after"])

        batch_key = None
        for b in batches:
            batch_key = b.schema.field("key").type
            for r in b.to_pylist():
                if size >= SUFFIX_BYTES and held[-1]["anchor"] != r["anchor"]:
                    yield from found()
                    held, size = [], 0
                held.append(r)
                size += len(r["raw"])
        if held:
            yield from found()

    n = int(touched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = (rows.where("raw is not null").select("anchor", "key", "first", "last", "n", "raw")
             .repartition(n, "anchor").sortWithinPartitions("anchor"))
    by_group = map_batches(edges, search, f"key {kind}, first long, after long")
    single = rows.where("raw is null")
    kinds = single.groupBy("anchor", "window").agg(F.count("*").alias("places"), F.min(F.struct("key", "first")).alias("rep"))
    by_window = single.join(kinds.where("places > 1"), ["anchor", "window"])
    if keep == "first":
        by_window = by_window.where(~((F.col("key") == F.col("rep.key")) & (F.col("first") == F.col("rep.first"))))
    return by_group.unionByName(by_window.select("key", "first", (F.col("first") + length).alias("after")))


def _cut(raw: bytes, spans: list[dict], whole_chars: bool = False) -> tuple[bytes, int]:
    """The bytes outside the spans, and how many maximal runs were removed.  With
    ``whole_chars`` a character goes only if all its bytes do."""
    kept, runs, at = [], 0, 0
    for s in [*spans, None]:
        first, after = (s["first"], s["after"]) if s else (len(raw), len(raw))
        if whole_chars and s:
            while first < len(raw) and raw[first] & 0xC0 == 0x80:
                first += 1
            while after < len(raw) and raw[after] & 0xC0 == 0x80:
                after -= 1
        if after <= at and s:
            continue
        if s and (first > at or not runs):
            runs += 1
        kept.append(raw[at:max(at, first)])
        at = max(at, after)
    return b"".join(kept), runs


def removal_report(docs: DataFrame, length: int = LENGTH, keep: str = "none", gram: int | None = None,
                   group: int = GROUP) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, digest of what is left."""
    touched = repeats(docs, length, keep, gram, group)
    kind = touched.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                left, runs = _cut(raw, spans)
                out.append((len(raw) - len(left), runs, hashlib.sha256(left).hexdigest()))
            removed, runs, sha = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
                names=["key", "n_removed", "n_spans", "kept_sha256"])

    cut = map_batches(touched, run, f"key {kind}, n_removed long, n_spans long, kept_sha256 string")
    text = F.coalesce("text", F.lit("")).cast("binary")
    every = docs.select("doc_id", doc_key().alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
                        F.sha2(text, 256).alias("whole_sha256"))
    return every.join(cut, every["key"].eqNullSafe(cut["key"]), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))


def deduplicated(docs: DataFrame, length: int = LENGTH, keep: str = "first") -> DataFrame:
    """The documents without the repeats, with the columns of ``docs``; a character
    goes only if all its bytes do."""
    touched = repeats(docs, length, keep)
    kind = touched.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [_cut(raw, spans, True)[0].decode("utf-8", "replace")
                     for raw, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["key", "left_text"])

    cut = map_batches(touched, run, f"key {kind}, left_text string")
    every = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), doc_key().alias("key"))
    joined = every.join(cut, every["key"].eqNullSafe(cut["key"]), "left")
    return joined.select(*[
        (F.coalesce("left_text", "row.text") if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns])
