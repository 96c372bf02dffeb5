"""Toxic passages by maximum-scoring segments over token log-odds.

1. Tokens of labelled documents, and their beginnings of ``STEMS`` characters as
   stems, are counted by class over all distinct labelled texts of the training
   part: copies of a text count once in a class.  A term's score is its log-odds between the classes with a Dirichlet prior in
   proportion to its overall frequency (total mass ``PRIOR``).  A token takes
   its own score, else that of its longest stem in the lexicon.
   A term enters the lexicon if its score is ``LEAST_SCORE``, the log-odds under a strong prior
   (``STRONG`` times its count) is ``LEAST_Z`` deviations above 0 and it occurs in
   at least ``LEAST_CONTEXTS`` different contexts (the token before it) of toxic
   documents.  Near copies of one toxic text bring its words often, but mostly in
   the same context, so a context counts no more occurrences than the term's
   ``LEAST_CONTEXTS``-th most frequent one: more near copies never take a term's
   other occurrences away, and no share of a count that grows with the corpus is
   asked for.  All other tokens score ``OTHER``.
2. A linear scan (Ruzzo and Tompa) finds every maximal-scoring segment of a
   text; all of them at or above ``LEAST_SEGMENT`` are passages.
3. Scores are calibrated by extreme values: the best segment of n random tokens
   is Gumbel distributed, P(S >= s) = 1 - exp(-K n exp(-lambda s)); lambda
   solves sum p exp(lambda score) = 1 over the non-toxic tokens, K is fitted to the
   non-toxic documents.  A document's r best segments have the sum statistic
   T = sum of (lambda s - ln(K n)), whose chance is about
   exp(-T) T^(r-1) / (r! (r-1)!); the evidence is the largest -ln of that over r,
   less r ln 2 for the choice.  The score is a logistic function of the evidence
   and of the text's length, fitted on a bounded sample of training documents.

Inputs of a score are the text alone.  The lexicon has every term that passes the
tests; one of more than ``MAX_TERMS`` terms, too large for a driver and a broadcast,
raises instead of being cut.

Defined cases: null and empty texts have no passage and the lowest score; with
labels of one class (or none) every score is 0; equal rows have equal scores;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import map_batches, stored
from pitchlens.llm.neardup import text_digest

TOKEN = re.compile(r"\w+")
PRIOR, STRONG = 100.0, 0.1
LEAST_SCORE, LEAST_Z, LEAST_CONTEXTS, MAX_TERMS = 1.0, 3.0, 8, 1_000_000
STEMS = (4, 5, 6, 7, 8)
OTHER = -0.25
LEAST_SEGMENT = 3.0
MAX_CALIBRATION = 20_000  # training documents the calibration is fitted on, at most
THRESHOLD = 0.3


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def segments(places: list[int], scores: list[float], n: int, other: float = OTHER) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, first, after) of n tokens that score
    ``other`` (at most 0) save for the given places; linear time."""
    # candidates: (sum before, sum through, first, after), as in Ruzzo and Tompa
    stack: list[tuple[float, float, int, int]] = []
    back: list[int] = []  # of each candidate: the nearest earlier one with a smaller sum before, or -1
    total, at = 0.0, 0
    for place, score in zip(places, scores, strict=True):
        total += other * (place - at)
        at = place + 1
        left, total = total, total + score
        if score <= 0:
            continue
        first, right = place, total
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= left:
                j = back[j]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, first, place + 1))
                back.append(j)
                break
            left, first = stack[j][0], stack[j][2]
            del stack[j:], back[j:]
    return [(r - a, first, after) for a, r, first, after in stack]


@dataclass(frozen=True)
class Model:
    scores: dict[str, float]
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    weights: tuple[float, float, float] = (0.0, 1.0, 0.0)  # of the logistic function
    lengths: tuple[float, float] = (0.0, 50.0)  # range of ln(1 + tokens) the function was fitted on

    def evidence(self, found: list[float], n: int) -> float:
        """Minus the logarithm of the chance of the text's best segments, at least 0."""
        chance = self.log_k + math.log(max(n, 1))
        out = total = 0.0
        for r, s in enumerate(sorted(found, reverse=True), 1):
            total += self.rate * s - chance
            if total > 0:
                out = max(out, total - (r - 1) * math.log(max(total, 1.0)) + math.lgamma(r + 1) + math.lgamma(r) - r * math.log(2))
        return out

    def score(self, evidence: float, n: int) -> float:
        if not self.scores:
            return 0.0
        length = min(max(math.log1p(n), self.lengths[0]), self.lengths[1])
        z = self.weights[0] + self.weights[1] * math.sqrt(evidence) + self.weights[2] * length
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def passages(self, words: list[str]) -> list[tuple[float, int, int]]:
        known, openings, shortest = self.scores, self.openings, STEMS[0]
        places, scores = [], []
        for i, w in enumerate(words):
            if w in known:
                places.append(i)
                scores.append(known[w])
            elif w[:shortest] in openings:
                stem = next((known[x] for k in reversed(STEMS) if len(w) > k and (x := w[:k] + "*") in known), None)
                if stem is not None:
                    places.append(i)
                    scores.append(stem)
        return segments(places, scores, len(words)) if places else []

    @cached_property
    def openings(self) -> frozenset[str]:
        """The first characters of all stems."""
        return frozenset(t[:STEMS[0]] for t in self.scores if t[-1] == "*")


def with_stems(words: list[str]) -> Iterator[str]:
    for w in words:
        yield w
        for k in STEMS:
            if len(w) > k:
                yield w[:k] + "*"


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _class_counts(labelled: DataFrame) -> DataFrame:
    """token, toxic, n; the empty token counts all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = tokens(text or "")
                by[toxic].update(with_stems(words))
                by[toxic][""] += len(words)
            for y, counts in enumerate(by):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array([y] * len(counts), pa.int32()),
                     pa.array(list(counts.values()), pa.int64())], names=["token", "toxic", "n"])

    return map_batches(labelled.select("text", "toxic"), run, "token string, toxic int, n long")


def _contexts(labelled: DataFrame, terms: DataFrame) -> DataFrame:
    """token, contexts (how many different ones toxic documents have it in), y1 (its
    occurrences there, of a context no more than of the ``LEAST_CONTEXTS``-th most frequent)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: Counter = Counter()
            for text in b.column(0).to_pylist():
                words = tokens(text or "")
                for before, w in zip(["", *words], words, strict=False):
                    found.update((t, before) for t in with_stems([w]))
            token, before = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(token, pa.string()), pa.array(before, pa.string()),
                                              pa.array(list(found.values()), pa.int64())], names=["token", "before", "n"])

    def cut(seen: Column, x: Column) -> Column:
        return F.when(seen["contexts"] >= LEAST_CONTEXTS, seen).otherwise(
            F.struct((seen["contexts"] + x["k"]).alias("contexts"), x["n"].alias("n")))

    pairs = map_batches(labelled.where("toxic = 1").select("text"), run, "token string, before string, n long")
    by = (pairs.join(terms.select("token"), "token", "left_semi").groupBy("token", "before").agg(F.sum("n").alias("n"))
          .groupBy("token", "n").agg(F.count("*").alias("k")))
    # distinct counts of a term: at most the root of twice its occurrences
    by = by.groupBy("token").agg(F.sum("k").alias("contexts"), F.sort_array(F.collect_list(F.struct("n", "k")), asc=False).alias("by"))
    none = F.struct(F.lit(0).cast("long").alias("contexts"), F.lit(0).cast("long").alias("n"))
    by = by.withColumn("most", F.aggregate("by", none, cut)["n"])
    total = F.aggregate("by", F.lit(0).cast("long"), lambda out, x: out + F.least(x["n"], F.col("most")) * x["k"])
    return by.select("token", "contexts", total.alias("y1"))


def _log_odds(y1: Column, y0: Column, n1: float, n0: float, a: Column, mass: float) -> Column:
    return F.log((y1 + a) / (n1 + mass - y1 - a)) - F.log((y0 + a) / (n0 + mass - y0 - a))


def learn(docs: DataFrame, labels: DataFrame, max_terms: int = MAX_TERMS,
          max_calibration: int = MAX_CALIBRATION) -> Model:
    """Learn from ``labels`` (doc_id, toxic 0/1) outside the held-out quarter."""
    known = (labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out())
             .select("doc_id", F.col("toxic").cast("int")))
    texts = docs.where("text is not null").where(~held_out()).select("doc_id", text_digest().alias("digest"), "text")
    # of each text one row a class; both sides grow with the corpus: one plan at every size
    firsts = (texts.select("doc_id", "digest").join(known.hint("merge"), "doc_id")
              .groupBy("digest", "toxic").agg(F.min("doc_id").alias("doc_id")))
    training = (texts.join(stored(firsts, "toxic-firsts").hint("merge"), ["doc_id", "digest"])
                .groupBy("doc_id", "digest", "toxic").agg(F.first("text").alias("text")))
    training = stored(training.select("doc_id", "text", "toxic"), "toxic-training")
    counts = _class_counts(training).groupBy("token").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0"))
    # rarer terms can't enter the lexicon
    counts = stored(counts.where((F.col("y1") >= LEAST_CONTEXTS) | (F.col("token") == "")), "toxic-counts")
    n1, n0 = (float(v or 0) for v in counts.where("token = ''").agg(F.sum("y1"), F.sum("y0")).first())
    if not n1 or not n0:
        return Model({})

    def passing(rows: DataFrame) -> DataFrame:
        y1, y0 = F.col("y1").cast("double"), F.col("y0").cast("double")
        share, strong = (y1 + y0) / (n1 + n0), (y1 + y0) * STRONG
        z = _log_odds(y1, y0, n1, n0, strong, (n1 + n0) * STRONG) / F.sqrt(1 / (y1 + strong) + 1 / (y0 + strong))
        return (rows.select("token", z.alias("z"), _log_odds(y1, y0, n1, n0, share * PRIOR, PRIOR).alias("score"), "y1", "y0")
                .where((F.col("z") >= LEAST_Z) & (F.col("score") >= LEAST_SCORE)))

    terms = stored(passing(counts.where(F.col("token") != "")), "toxic-terms")
    spread = _contexts(training, terms).where(F.col("contexts") >= LEAST_CONTEXTS)
    scored = passing(spread.join(terms.select("token", "y0"), "token"))
    chosen = scored.orderBy("token").limit(max_terms + 1).collect()
    if len(chosen) > max_terms:
        raise ValueError(f"more than {max_terms} terms pass the lexicon's tests")
    model = Model({r["token"]: float(r["score"]) for r in chosen})
    if not chosen:
        return model
    # the rate: scores of non-toxic tokens
    p = np.array([r["y0"] / n0 for r in chosen])
    s = np.array([r["score"] for r in chosen])
    rest = max(0.0, 1 - p.sum())
    low, high = 1e-3, 5.0
    for _ in range(80):
        mid = (low + high) / 2
        with np.errstate(over="ignore"):
            low, high = (mid, high) if (p * np.exp(mid * s)).sum() + rest * math.exp(mid * OTHER) < 1 else (low, mid)
    model = Model(model.scores, low)
    # the sample is chosen by id; only numbers reach the driver
    ids = training.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_calibration).distinct()
    sample = training.join(F.broadcast(ids), "doc_id")  # max_calibration ids at most
    rows = (with_best(sample, model, "toxic").select("n", "toxic", "best", "found").orderBy(F.xxhash64("doc_id"))
            .limit(2 * max_calibration).collect())  # ids may repeat
    y = np.array([r["toxic"] for r in rows], float)
    best, n = np.array([r["best"] for r in rows], float), np.array([max(r["n"], 1) for r in rows], float)
    clean = (y == 0) & (best > 0)
    # the mean of a Gumbel variable lies 0.5772 above ln(K n)
    log_k = float((model.rate * best[clean] - np.log(n[clean])).mean() - 0.5772) if clean.sum() >= 20 else \
        math.log((clean.sum() + 0.5) / max(n[y == 0].sum(), 1)) + model.rate * float(s.min())
    model = Model(model.scores, model.rate, log_k)
    x = np.array([(math.sqrt(model.evidence(r["found"], r["n"])), math.log1p(r["n"])) for r in rows])
    low, high = map(float, np.quantile(x[:, 1], (0.05, 0.95)))
    x[:, 1] = np.clip(x[:, 1], low, high)
    return Model(model.scores, model.rate, log_k, fit_logistic(x, y), (low, high))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """(intercept, slopes) by Newton's method with a small ridge."""
    if not len(y) or y.min() == y.max():
        return (20.0 if len(y) and y.all() else -20.0, *[0.0] * x.shape[-1])
    mean, scale = x.mean(0), np.where(x.std(0) > 0, x.std(0), 1.0)
    a = np.column_stack((np.ones(len(x)), (x - mean) / scale))
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        w += np.linalg.solve(h, a.T @ (y - p) - ridge * w)
    slopes = w[1:] / scale
    return (float(w[0] - (slopes * mean).sum()), *map(float, slopes))


def with_best(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """doc_id, carried columns, n (tokens), best (segment score), score, found (scores of
    all maximal segments), passages."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    extra = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in carried)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MAX_TERMS tokens at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n, best, score, every, found = [], [], [], [], []
            for text in b.column(0).to_pylist():
                words = tokens(text or "")
                all_ = m.passages(words)
                top = max((s for s, _, _ in all_), default=0.0)
                n.append(len(words))
                best.append(top)
                every.append([s for s, _, _ in all_])
                score.append(m.score(m.evidence(every[-1], len(words)), len(words)))
                found.append([{"first": a, "after": e, "score": s} for s, a, e in all_ if s >= LEAST_SEGMENT])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array(n, pa.int64()), pa.array(best, pa.float64()),
                 pa.array(score, pa.float64()), pa.array(every, pa.list_(pa.float64())),
                 pa.array(found, pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("score", pa.float64())])))],
                names=["doc_id", *carried, "n", "best", "score", "found", "passages"])

    return map_batches(docs.select("text", "doc_id", *carried), run,
                       f"doc_id {kind}, {extra}n long, best double, score double, found array<double>, "
                       "passages array<struct<first:bigint,after:bigint,score:double>>")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages, best (the top segment's score)."""
    return with_best(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("passages").cast("long").alias("n_passages"), "best")
