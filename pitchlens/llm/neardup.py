"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles are ``SHINGLE`` consecutive words (white-space separated); a text
   of fewer words, but not none, is one shingle.  A shingle's weight in a text
   is its count there times a damped inverse frequency, ``FLOOR`` + (1 - ``FLOOR``)
   ln(1 + N / df) / ln(1 + N): a rare shingle weighs up to a third more than the
   commonest.  (Undamped, a passage that a large group of near copies shares counts
   so little that the group's few edits make its members look unlike.)  df is
   counted over all documents for ``FEATURES`` hashed features, a table of fixed
   size however large the corpus is.
2. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples per
   distinct text; two texts agree in a sample with the probability of their
   weighted Jaccard similarity.  ``ROWS`` samples make a band.  At similarity
   0.8 two texts share none of the 13 bands with probability 9e-5.
3. First, in every band's bucket each text meets the bucket's smallest and
   largest text: aggregations and joins that split like any skewed join.  Verified
   links make classes.  What is still in different classes then meets inside the
   bucket: in a task, block against block, sketches are compared (a byte per
   sample), and every pair whose sketches agree is verified there, in the first
   bucket its texts share.  No pair leaves the task: only a forest that joins the
   classes found linked, and each text's number of links, so rows stay in
   proportion to the texts however many pairs a group has.
   Texts of a bucket are dealt into blocks of about ``BUCKET`` texts and
   ``BLOCK_BYTES``; every block of texts outside the bucket's largest class meets
   every block of the bucket in a task of its own, so all pairs of a bucket meet,
   whatever its size.
4. Candidates are verified by the exact weighted Jaccard similarity of the
   whole texts, at least ``SIMILARITY``.
5. Classes are the connected components of verified links, by label
   propagation with pointer jumping over written tables.

Exact copies are one text with several members, so they cost no pairs.

Defined cases: null texts and texts without words are classes of their own;
equal rows are members of one class; an empty table gives no rows; further
columns are carried by ``one_per_class`` whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlens.llm.common import map_batches, stored
from pitchlens.llm.words import mix, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 3, 13
FEATURES = 1 << 18  # hashed features document frequencies are counted for
FLOOR = 0.75  # weight of a shingle that every document has, against 1 for the rarest
BUCKET = 4096
BLOCK_BYTES = 8 << 20
# a pair of at least SIMILARITY agrees in fewer of its samples with probability 3e-6
LEAST_AGREEING = 19
PIECE_BYTES = 1 << 20


def shingle_counts(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of the distinct shingles of each text, by text and shingle."""
    raws = [t.encode("utf-8", "replace") for t in texts]
    start, _, h = word_hashes(np.frombuffer(b" ".join(raws), np.uint8))
    ends = np.cumsum([len(r) + 1 for r in raws])
    words = np.diff(np.searchsorted(start, ends), prepend=0)  # of each text
    doc = np.repeat(np.arange(len(texts)), words)
    factors = mix(np.arange(1000, 1000 + size, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - size + 1)
    s = np.zeros(n, np.uint64)
    for k in range(size):
        s += h[k:n + k] * factors[k]
    inside = doc[:n] == doc[size - 1:] if n else np.zeros(0, bool)
    s, doc = mix(s[inside] + np.uint64(size)), doc[:n][inside]
    for i in np.flatnonzero((words > 0) & (words < size)):  # shorter texts: one shingle of all words
        at = int(words[:i].sum())
        own = h[at:at + words[i]]
        s = np.append(s, mix((own * factors[:len(own)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(own))))
        doc = np.append(doc, i)
    order = np.argsort(s)
    order = order[np.argsort(doc[order].astype(np.int32), kind="stable")]
    s, doc = s[order], doc[order]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(s) != 0) | (np.diff(doc) != 0)))) if len(s) else np.zeros(0, np.int64)
    return doc[new], s[new], np.diff(np.append(new, len(s)))


def pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first, texts): the texts, some at a time."""
    at = 0
    while at < len(texts):
        first, size, part = at, 0, []
        while at < len(texts) and size < PIECE_BYTES:
            part.append(texts[at] or "")
            size += len(part[-1])
            at += 1
        yield first, part


def feature(shingle: np.ndarray) -> np.ndarray:
    return (shingle & np.uint64(FEATURES - 1)).astype(np.int64)


def weights(text: str, idf: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles, sorted; their TF-IDF weights)."""
    _, s, n = shingle_counts([text], size)
    return s, n.astype(np.float32) * idf[feature(s)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - both
    return both / total if total else 0.0


@lru_cache(maxsize=2)
def _draws() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of Gamma(2, 1): r (4096 of them) and ln c (65536)."""
    x = np.concatenate((np.geomspace(1e-6, 1, 200_000), np.linspace(1, 30, 200_000)[1:]))
    cdf = -np.expm1(-x) - x * np.exp(-x)
    quantile = lambda n: np.interp((np.arange(n) + 0.5) / n, cdf, x)
    return quantile(4096).astype(np.float32), np.log(quantile(65536)).astype(np.float32)


def samples(doc: np.ndarray, s: np.ndarray, w: np.ndarray, n: int = ROWS * BANDS) -> np.ndarray:
    """The consistent weighted samples of weighted sets, given by set, as 64-bit
    hashes of (element, t): a row of ``n`` per set."""
    r_of, ln_c = _draws()
    first = np.flatnonzero(np.concatenate(([True], np.diff(doc) != 0)))
    out = np.zeros((len(first), n), np.uint64)
    rank = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(doc))))
    log_w = np.log(w)
    u = np.uint64
    for k, seed in enumerate(mix(np.arange(77, 77 + n, dtype=np.uint64))):
        z = s ^ seed
        z *= u(0x9E3779B97F4A7C15)
        z ^= z >> u(32)
        z *= u(0xD6E8FEB86659FD93)
        r = r_of.take((z >> u(52)).view(np.int64))
        beta = ((z >> u(40)) & u(4095)).astype(np.float32)
        beta += np.float32(0.5)
        beta *= np.float32(1 / 4096)
        t = log_w / r
        t += beta
        np.floor(t, out=t)
        a = ln_c.take(((z >> u(24)) & u(65535)).view(np.int64))
        beta -= t
        beta -= np.float32(1)
        beta *= r
        a += beta  # ln c - r (t - beta + 1)
        least = np.minimum.reduceat(a, first)
        at = np.flatnonzero(a == least.take(rank))
        if len(at) > len(first):  # ties: the smallest element
            at = at[np.flatnonzero(np.concatenate(([True], np.diff(rank[at]) != 0)))]
        out[:, k] = s[at] ^ mix(t[at].astype(np.int64).view(u)) ^ seed
    return mix(out)


def bands(sample: np.ndarray) -> np.ndarray:
    """A 64-bit key per band of ``ROWS`` samples, for each row of samples."""
    return mix((sample.reshape(-1, BANDS, ROWS) * mix(np.arange(5, 5 + ROWS, dtype=np.uint64))).sum(2, dtype=np.uint64)
               + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """The damped inverse frequency per hashed feature, over all documents; ``FEATURES`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(FEATURES, np.int64)
        n = 0
        for b in batches:
            n += b.num_rows
            for _, part in pieces(b.column(0).to_pylist()):
                counts += np.bincount(feature(shingle_counts(part)[1]), minlength=FEATURES)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))],
                                         names=["feature", "n"])

    total = map_batches(docs.select("text"), run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts = np.zeros(FEATURES + 1, np.float64)
    for r in total.collect():  # FEATURES + 1 rows at most
        counts[r["feature"]] = r["n"]
    n = max(counts[-1], 1)
    return (FLOOR + (1 - FLOOR) * np.log1p(n / np.maximum(counts[:-1], 1)) / np.log1p(n)).astype(np.float32)


def text_digest():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _texts(docs: DataFrame, idf) -> DataFrame:
    """Per distinct text with words: node (digest), first (smallest doc_id), copies, bands, sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.where("text is not null").select(text_digest().alias("node"), "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            keep, found = [], [np.zeros((0, ROWS * BANDS), np.uint64)]
            for first, part in pieces(b.column(2).to_pylist()):
                doc, s, n = shingle_counts(part)
                if len(doc):
                    found.append(samples(doc, s, n.astype(np.float32) * table[feature(s)]))
                    keep.append(np.unique(doc) + first)
            at = pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64))
            sample = np.concatenate(found)
            ends = pa.array(np.arange(len(sample) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at),
                 pa.ListArray.from_arrays(ends, pa.array(bands(sample).ravel())),
                 pa.array([x.tobytes() for x in sample.astype(np.uint8)], pa.binary())],
                names=["node", "doc_id", "bands", "sketch"])

    rows = map_batches(keyed, run, f"node binary, doc_id {kind}, bands array<long>, sketch binary")
    return rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"),
                                    F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))


def _agreeing(pairs: DataFrame) -> DataFrame:
    """The pairs (a, sketch_a, b, sketch_b) whose sketches agree often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = ROWS * BANDS
        for b in batches:
            a, c = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(-1, n) for k in (1, 3))
            keep = pa.array(np.flatnonzero((a == c).sum(1) >= LEAST_AGREEING))
            yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(2).take(keep)], names=["a", "b"])

    return map_batches(pairs.select("a", "sketch_a", "b", "sketch_b"), run, "a binary, b binary", batch_rows=10_000)


def _cells(members: DataFrame, roots: DataFrame, texts: DataFrame, bucket: int, block_bytes: int) -> DataFrame:
    """band, row, col, node, root, own, asks, met, sketch, bands, text: of buckets with several
    classes, the cells (row block, column block) each text is in; it asks in its row, is met
    in its column.  Texts of the bucket's largest class (not own) don't ask."""
    rooted = (members.select("band", "node").join(texts.select("node", F.octet_length("text").alias("bytes")), "node")
              .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).groupBy("band").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.struct("n", "root", "bytes")).alias("largest"))
    blocks = lambda n, size: F.greatest(F.ceil(n / bucket), F.ceil(size / block_bytes))
    sizes = stored(sizes.where("n > largest.n").select(
        "band", F.col("largest.root").alias("largest"),
        blocks(F.col("n") - F.col("largest.n"), F.col("bytes") - F.col("largest.bytes")).alias("rows"),
        blocks(F.col("n"), F.col("bytes")).alias("cols")), "near-sizes")
    cell = lambda row, col: F.struct(row.alias("row"), col.alias("col"))
    placed = (rooted.join(sizes, "band").withColumn("own", F.col("root") != F.col("largest"))
              .withColumn("at_row", F.pmod(F.xxhash64("node"), "rows")).withColumn("at_col", F.pmod(F.xxhash64("node", "band"), "cols")))
    asked = F.when(F.col("own"), F.transform(F.sequence(F.lit(0), F.col("cols") - 1), lambda c: cell(F.col("at_row"), c)))
    met = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda r: cell(r, F.col("at_col")))
    dealt = placed.withColumn("cell", F.explode(F.array_union(F.coalesce(asked, F.array().cast("array<struct<row:bigint,col:bigint>>")), met)))
    return dealt.select("band", "cell.row", "cell.col", "node", "root", "own",
                        (F.col("own") & (F.col("cell.row") == F.col("at_row"))).alias("asks"),
                        (F.col("cell.col") == F.col("at_col")).alias("met")).join(texts, "node").select(
        "band", "row", "col", "node", "root", "own", "asks", "met", "sketch", "bands", "text")


def similar(texts: list[str], x: np.ndarray, y: np.ndarray, idf: np.ndarray, similarity: float) -> np.ndarray:
    """Which pairs of texts (x, y), ordered by x, are similar: the exact weighted Jaccard
    similarity, of each text with all its partners at a time.  All texts have words."""
    parts = [(doc + first, s, n) for first, part in pieces(texts) for doc, s, n in [shingle_counts(part)]]
    doc, s, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    w = (n.astype(np.float32) * idf[feature(s)]).astype(np.float64)
    s = np.unique(s, return_inverse=True)[1]
    start = np.searchsorted(doc, np.arange(len(texts) + 1))
    total = np.add.reduceat(w, start[:-1])
    own = np.zeros(int(s.max()) + 1)
    out = np.zeros(len(x), bool)
    ends = np.append(np.flatnonzero(np.diff(x)) + 1, len(x))
    for at, after in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        i, j = x[at], y[at:after]
        mine = slice(start[i], start[i + 1])
        own[s[mine]] = w[mine]
        size = start[j + 1] - start[j]
        first = np.cumsum(size) - size
        k = np.repeat(start[j] - first, size) + np.arange(int(size.sum()))
        both = np.add.reduceat(np.minimum(own[s[k]], w[k]), first)
        out[at:after] = both / (total[i] + total[j] - both) >= similarity
        own[s[mine]] = 0
    return out


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Of the links (a, b) those that join parts not joined by links before them."""
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while (up := root.get(i, i)) != i:
            root[i] = root.get(up, up)
            i = root[i]
        return i

    out = []
    for i, j in sorted(set(zip(a.tolist(), b.tolist(), strict=True))):
        p, q = find(i), find(j)
        if p != q:
            root[q] = p
            out.append((i, j))
    return out


def _across(cells: DataFrame, idf, similarity: float) -> DataFrame:
    """Of all verified links between texts of different classes (root): (a, b, null), a
    forest of each cell that joins the classes, and (node, null, n), links of each text."""

    def agreeing(band: int, roots: np.ndarray, own: np.ndarray, asks: np.ndarray, met: np.ndarray, sketches: np.ndarray,
                 bands: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a text that asks and one that it meets, each unordered pair in one cell of one bucket."""
        place = int(np.flatnonzero(bands[0] == band)[0])
        xs, ys = [], []
        for at in range(0, len(asks), 64):
            rows = asks[at:at + 64]
            near = np.concatenate([
                (sketches[rows, None, :] == sketches[None, met[other:other + 2048], :]).sum(2, dtype=np.uint8)
                for other in range(0, len(met), 2048)], axis=1)
            near[roots[rows, None] == roots[None, met]] = 0
            near[own[met][None, :] & (met[None, :] < rows[:, None])] = 0  # these ask, too
            i, j = np.nonzero(near >= LEAST_AGREEING)
            x, y = rows[i], met[j]
            new = ~(bands[x, :place] == bands[y, :place]).any(1)
            xs.append(x[new].astype(np.int32))
            ys.append(y[new].astype(np.int32))
        return np.concatenate(xs), np.concatenate(ys)

    def found(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        band, _, _, nodes, roots, own, asks, met, sketches, keys, texts = zip(*held, strict=True)
        if not any(asks) or not any(met):  # few texts may leave a block empty
            return
        names, root = np.unique(np.array(roots, dtype=object), return_inverse=True)
        x, y = agreeing(band[0], root, np.array(own), np.flatnonzero(asks), np.flatnonzero(met),
                        np.frombuffer(b"".join(sketches), np.uint8).reshape(len(nodes), -1), np.array(keys, np.int64))
        if not len(x):
            return
        some = np.unique(np.concatenate((x, y)))  # texts with a partner
        at = similar([texts[i] for i in some.tolist()], np.searchsorted(some, x), np.searchsorted(some, y), idf.value, similarity)
        x, y = x[at], y[at]
        links = np.bincount(np.concatenate((x, y)), minlength=len(nodes))
        linked = np.flatnonzero(links).tolist()
        trees = forest(np.minimum(root[x], root[y]), np.maximum(root[x], root[y]))
        if linked:
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i, _ in trees] + [nodes[i] for i in linked], pa.binary()),
                 pa.array([names[j] for _, j in trees] + [None] * len(linked), pa.binary()),
                 pa.array([None] * len(trees) + links[linked].tolist(), pa.int64())], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(b.column(k).to_pylist() for k in range(11)), strict=True):
                if held and held[-1][:3] != row[:3]:
                    yield from found(held)
                    held = []
                held.append(row)
        if held:
            yield from found(held)

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(cells.repartition(n, "band", "row", "col").sortWithinPartitions("band", "row", "col", "node"),
                       run, "a binary, b binary, n long", batch_rows=500)


def _verified(pairs: DataFrame, texts: DataFrame, idf, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        known: dict[bytes, tuple] = {}
        for b in batches:
            keep = []
            for i, (x, y, s, t) in enumerate(zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)):
                if len(known) > 200:
                    known.clear()
                for node, text in ((x, s), (y, t)):
                    if node not in known:
                        known[node] = weights(text, table)
                if weighted_jaccard(known[x], known[y]) >= similarity:
                    keep.append(i)
            at = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at)], names=["a", "b"])

    both = (pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
            .join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b"))
    return map_batches(both.select("a", "b", "text_a", "text_b").sortWithinPartitions("b"), run, "a binary, b binary", batch_rows=500)


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node of its component) for all nodes of links (a, b)."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("low"))
                    .select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "labels")
    while True:
        # the smallest label of any neighbour ...
        near = (both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("low")))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("was"), F.least("root", "low").alias("root"))
        lower = stored(lower, "labels")
        # ... and the label of that label
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        new = stored(lower.join(jump, "root").select("node", "was", F.least("root", "next").alias("root")), "labels")
        if new.where("was != root").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per distinct text with words: node (digest), class_id (smallest doc_id of its
    class), copies (documents with this text), links (verified links of the text)
    and class_size (documents in the class)."""
    spark: SparkSession = docs.sparkSession
    idf = spark.sparkContext.broadcast(inverse_frequencies(docs))  # FEATURES numbers
    nodes = stored(_texts(docs, idf), "near-texts")
    rows = nodes.select("node", F.explode("bands").alias("band"))
    # stored, so that the join's sides are plain shuffles, which split where a bucket is hot
    shared = stored(rows.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"))
                    .where("n > 1"), "near-shared")
    members = stored(rows.join(shared, "band"), "near-buckets")
    met = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", "sketch", "bands")
    texts = stored(docs.where("text is not null").select(text_digest().alias("node"), "text")
                   .join(met, "node").dropDuplicates(["node"]), "near-text")

    # the ends of every bucket
    sketch = lambda c: texts.select(F.col("node").alias(c), F.col("sketch").alias(f"sketch_{c}"))
    ends = (members.select(F.col("node").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a != b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    pairs = stored(_agreeing(ends.join(sketch("a"), "a").join(sketch("b"), "b")), "near-pairs")
    links = stored(_verified(pairs, texts.select("node", "text"), idf, similarity), "near-links")
    roots = components(links)
    # all others, inside the buckets
    found = stored(_across(_cells(members, roots, texts, bucket, block_bytes), idf, similarity), "near-found")
    joined = components(found.where("b is not null")).select(F.col("node").alias("root"), F.col("root").alias("top"))
    ends = (links.select(F.explode(F.array("a", "b")).alias("node"), F.lit(1).alias("n"))
            .unionByName(found.where("b is null").select(F.col("a").alias("node"), "n")).groupBy("node").agg(F.sum("n").alias("links")))
    named = (nodes.select("node", "first", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
             .join(joined, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top"))
    whole = named.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    return stored(named.join(whole, "root").join(ends, "node", "left").select(
        "node", "class_id", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"), "class_size"), "near-classes")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bucket: int = BUCKET) -> DataFrame:
    """Per document: doc_id, class_id, copies, links, class_size."""
    found = classes(docs, similarity, bucket)
    return (docs.select("doc_id", text_digest().alias("node")).join(found, "node", "left")
            .select("doc_id",
                    F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
                    F.coalesce("links", F.lit(0)).cast("long").alias("links"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size")))


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, that with the smallest doc_id (rows without an id
    last), with the columns of ``docs``."""
    several = classes(docs, similarity).where("class_size > 1").select("node", F.col("node").alias("class"), "class_id", "class_size")
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text_digest().alias("node"))
    joined = packed.join(several, "node", "left")
    single = joined.where("class_id is null and class_size is null").select("row")
    # a class is named by its smallest id; classes of rows without any id, by their text
    name = F.struct("class_id", F.when(F.col("class_id").isNull(), F.col("class")))
    chosen = (joined.where("class_size is not null and row.doc_id <=> class_id").select("row", name.alias("name"))
              .withColumn("k", F.row_number().over(Window.partitionBy("name").orderBy(F.xxhash64("row.text"), F.xxhash64("row"))))
              .where("k = 1").select("row"))
    return single.unionByName(chosen).select("row.*")
