"""SimHash fingerprints linked by covering locality-sensitive hashing.

1. *Fingerprint.*  A text's shingles are its 4-word sequences, repeats included, with
   A-Z in lower case and single spaces (all words where there are fewer).  A bit is
   1 if more than half of the shingles' XXH64 (seed 42) have it; without words the
   fingerprint is zero.
2. *Tables.*  Each of the 64 bit places has a vector of ``radius + 1`` bits, not zero.
   For every vector v but zero, table v keeps the places whose vector has an odd
   number of ones in common with v: a mask of about half the places.  The vectors
   of up to ``radius`` places span no more than ``radius`` dimensions, so some v is
   orthogonal to all of them and its mask holds none of these places: two
   fingerprints that differ in ``radius`` bits or fewer agree under at least one of
   the 31 masks, always.
3. *Buckets.*  Distinct fingerprints that agree under a mask are compared in their
   bucket.  A bucket of more than ``limit`` is dealt again by a second family of
   masks over what the first leaves open, and so on: each family covers all close
   pairs, so none is lost, rows grow 31-fold for hot buckets only, and each family
   about halves the open places.  Some table of each leaves any ``radius`` places
   open, so distinct fingerprints come under a limit well above 2 ** radius.
4. *Components.*  What links inside a bucket leaves the task as one tree per connected
   part (node k linked to node (k - 1) // 2), not as pairs: no more rows than came in,
   no node of high degree.  Trees are merged by label propagation with pointer
   jumping over written tables.

Exact copies, and all texts of one fingerprint, are one node, named by its smallest
doc_id, so the label a component ends with is its smallest doc_id.

Defined cases: null and empty texts have fingerprint zero and link like any other;
rows that repeat each get a result; rows without a doc_id are no nodes, they get the
component of the rows with an id that share their fingerprint, else null; an empty
table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import map_batches, stored
from pitchlens.llm.neardup import components, pieces

SHINGLE = 4
RADIUS = 4
SEED = 42
LIMIT = 1024  # fingerprints of a bucket compared at once
HELD = 4096  # rows of whole buckets a task holds at once, or one bucket
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
CHUNK = 1 << 18  # shingles whose bits are counted at once


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """The 64-bit fingerprint, as a signed number."""
    words = WORD.findall(text.encode("utf-8", "replace").lower())
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[:len(words) - size + 1], ends[size - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, len(starts), CHUNK):
        h = np.array([digest(whole[s:e], SEED) for s, e in zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist(), strict=True)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.int64)[0])


def masks(radius: int = RADIUS, family: int = 0) -> list[int]:
    """The masks of a covering family, as signed numbers; vectors are dealt evenly over the places."""
    n = (1 << radius + 1) - 1
    vectors = np.random.default_rng(family).permutation(np.arange(64) % n + 1)
    return [int(sum(1 << place for place, x in enumerate(vectors.tolist()) if (x & v).bit_count() % 2)
                - (1 << 64) * ((int(vectors[63]) & v).bit_count() % 2)) for v in range(1, n + 1)]


def trees(prints: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): row numbers that join each bucket's connected parts, parents before children;
    rows come by bucket and, in a bucket, by name."""
    n = len(prints)
    ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, n)
    rest = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # rows of the bucket from here on
    label = np.arange(n)  # the first row of each row's part
    at, step = np.flatnonzero(rest > 1), 1
    while len(at):
        a = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= radius]
        b = a + step
        while True:  # pairs of different parts: the later part joins the earlier one
            unlike = label[a] != label[b]
            if not unlike.any():
                break
            a, b = a[unlike], b[unlike]
            np.minimum.at(label, np.maximum(label[a], label[b]), np.minimum(label[a], label[b]))
            while not np.array_equal(label, label[label]):
                label = label[label]
        step += 1
        at = at[rest[at] > step]
    order = np.argsort(label, kind="stable")
    own = label[order]
    first = np.searchsorted(own, own)
    rank = np.arange(n) - first
    child = np.flatnonzero(rank > 0)
    return order[first[child] + (rank[child] - 1) // 2], order[child]


def _linked(members: DataFrame, kind: str, radius: int) -> DataFrame:
    """The trees (a, b) of names (first) of the buckets (t, key), each in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found(rows: pa.Table, t: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
            new = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            bucket = np.zeros(len(t), np.int64)
            bucket[new] = 1
            a, b = trees(rows.column("fp").to_numpy().view(np.uint64), np.cumsum(bucket), radius)
            names = rows.column("first").combine_chunks()
            return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b))], names=["a", "b"])

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            t, key = (rows.column(c).to_numpy() for c in ("t", "key"))
            whole = len(t)
            if not last:  # the last bucket may go on
                unlike = np.flatnonzero((t != t[-1]) | (key != key[-1]))
                whole = int(unlike[-1]) + 1 if len(unlike) else 0
            if whole:
                yield found(rows.slice(0, whole), t[:whole], key[:whole])
            held[:] = rows.slice(whole).to_batches()

        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= HELD:
                yield from flush(False)
                n = sum(b.num_rows for b in held)
        if held:
            yield from flush(True)

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.select("t", "key", "fp", "first").repartition(n, "t", "key").sortWithinPartitions("t", "key", "first")
    return map_batches(dealt, run, f"a {kind}, b {kind}", batch_rows=10_000)


def links(nodes: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(a, b): names (``first``) of fingerprints (``fp``, distinct) that span the components of
    the fingerprints within ``radius`` bits of one another."""
    if limit < 4 ** radius:
        raise ValueError(f"a limit below {4 ** radius} may never be reached")
    kind = nodes.schema["first"].dataType.simpleString()

    def dealt(rows: DataFrame, family: int) -> DataFrame:
        under = F.transform(F.array(*map(F.lit, masks(radius, family))), lambda m: F.col("fp").bitwiseAND(m))
        n = (1 << radius + 1) - 1
        rows = rows.select("t", "key", "fp", "first", F.posexplode(under).alias("v", "part"))
        return rows.select((F.col("t") * n + F.col("v")).alias("t"), F.col("key").bitwiseOR(F.col("part")).alias("key"), "fp", "first")

    rows = dealt(nodes.select(F.lit(0).cast("long").alias("t"), F.lit(0).cast("long").alias("key"), "fp", "first"), 0)
    out, family = None, 0
    while True:
        sizes = stored(rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"), "cover-sizes")
        found = _linked(rows.join(sizes.where(F.col("n") <= limit), ["t", "key"]), kind, radius)
        out = found if out is None else out.unionByName(found)
        hot = sizes.where(F.col("n") > limit)
        if hot.isEmpty():
            return stored(out.distinct(), "cover-links")
        family += 1
        rows = stored(dealt(rows.join(hot.select("t", "key"), ["t", "key"]), family), "cover-hot")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id and fp, the fingerprint as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, size) for _, part in pieces(b.column(1).to_pylist()) for t in part]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, fp long")


def similar(docs: DataFrame, radius: int = RADIUS, limit: int = LIMIT, size: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, fp and component_id, the smallest doc_id reachable by links."""
    prints = stored(fingerprints(docs, size), "prints")
    nodes = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")), "print-nodes")
    roots = components(links(nodes, radius, limit)).select(F.col("node").alias("first"), "root")
    named = stored(nodes.join(roots, "first", "left").select("fp", F.coalesce("root", "first").alias("component_id")), "print-components")
    return prints.join(named, "fp", "left").select("doc_id", "fp", "component_id")
