"""Quality rules: a decision list learned by sequential covering.

Per document a few counts are taken over the whole text.  From labelled
documents (a bounded sample, ``MAX_LABELLED`` rows in hash order) rules are
learned that reject bad documents: one rule at a time is *grown* condition by
condition (threshold on one statistic, best information gain) on two thirds of
the sample, *pruned* from its end on the remaining third, and the documents it
covers are removed before the next.  The list becomes one ordered Spark
``CASE WHEN`` over the statistics, so verdicts run in the JVM.

Defined cases: a null text has no words; an empty text gives zeros and fails
the base rule; equal rows get equal verdicts; with no labels (or one class)
the list is empty and keeps everything the base rule keeps; further columns,
whatever their names, are carried by ``keep_good`` and ignored otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import map_batches

MAX_LABELLED = 20_000  # labelled rows the list is learned from, at most
WORD = re.compile("[^\x20\x09-\x0d]+")
SYMBOLS = "#*$%&|<>"  # fixed values
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper")
#: statistic -> (numerator, denominator); what rules put thresholds on
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_word_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
}
FEATURES = ("n_words", *RATIOS)


def repeat_words(words: list[str]) -> tuple[int, int]:
    """(words inside a 3-word window that the text has twice or more, distinct words)."""
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(a) < 4:
        return 0, len(ids)
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 1_000_000:  # keep the product below 2**63
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + a[2:]
    order = np.argsort(window)
    same = np.diff(window[order]) == 0
    twice = np.zeros(len(window), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(len(a), bool)
    for k in range(3):
        hit[k:len(hit) - 2 + k] |= twice
    return int(hit.sum()), len(ids)


def text_stats(text: str) -> tuple[int, ...]:
    """The counts of ``STATS`` for one whole text."""
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    repeated, distinct = repeat_words(words)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated, lines, distinct,
            int(((raw >= 65) & (raw <= 90)).sum()))


def with_stats(docs: DataFrame) -> DataFrame:
    """``row`` (the whole input row) and the statistics of its text."""
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0)
            texts = rows.field(rows.type.get_field_index("text")).to_pylist()
            stats = list(zip(*(text_stats(t or "") for t in texts), strict=True)) or [[]] * len(STATS)
            yield pa.RecordBatch.from_arrays(
                [rows, *(pa.array(s, pa.int64()) for s in stats)], names=["row", *STATS])

    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"{s} long" for s in STATS)
    return map_batches(packed, run, schema)


def feature(name: str) -> Column:
    if name not in RATIOS:
        return F.col(name).cast("double")
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(0.0)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    threshold: float

    def column(self) -> Column:
        return feature(self.name) > self.threshold if self.above else feature(self.name) <= self.threshold

    def holds(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.name)]
        return v > self.threshold if self.above else v <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass
class DecisionList:
    """Rules tried in order; the first that holds rejects, else the text is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def kept(self) -> Column:
        out = F.when(F.lit(False), F.lit(False))
        for rule in self.rules:
            test = F.lit(True)
            for c in rule:
                test = test & c.column()
            out = out.when(test, F.lit(False))
        return out.otherwise(F.lit(True))

    def keeps(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for rule in self.rules:
            out &= ~covered(rule, x)
        return out

    def __str__(self) -> str:
        return "; ".join("reject if " + " and ".join(map(str, r)) for r in self.rules) + "; else keep"


def covered(rule: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    hit = np.ones(len(x), bool)
    for c in rule:
        hit &= c.holds(x)
    return hit


def _cuts(v: np.ndarray, bad: np.ndarray, most: int = 64) -> np.ndarray:
    """Midpoints between neighbouring values of different class, ``most`` spread over them."""
    order = np.argsort(v, kind="stable")
    v, bad = v[order], bad[order]
    at = np.flatnonzero((np.diff(v) > 0) & ((np.diff(bad.astype(int)) != 0) | (np.arange(len(v) - 1) % max(1, len(v) // 16) == 0)))
    if len(at) > most:
        at = at[np.linspace(0, len(at) - 1, most).astype(int)]
    return (v[at] + v[at + 1]) / 2


def _grow(x: np.ndarray, bad: np.ndarray, most: int) -> tuple[Condition, ...]:
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most and bad[inside].any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        best, gain = None, 1e-9
        for j, name in enumerate(FEATURES):
            for cut in _cuts(x[inside, j], bad[inside]):
                for above in (True, False):
                    hit = inside & ((x[:, j] > cut) == above)
                    p, n = bad[hit].sum(), (~bad[hit]).sum()
                    g = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else 0.0
                    if g > gain:
                        best, gain = Condition(name, above, float(cut)), g
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return tuple(rule)


def _prune(rule: tuple[Condition, ...], x: np.ndarray, bad: np.ndarray) -> tuple[Condition, ...]:
    def worth(r: tuple[Condition, ...]) -> float:
        hit = covered(r, x)
        p, n = bad[hit].sum(), (~bad[hit]).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best = rule
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) >= worth(best):
            best = rule[:k]
    return best


def learn(x: np.ndarray, bad: np.ndarray, most_rules: int = 16, most_conditions: int = 4,
          precision: float = 0.9) -> DecisionList:
    """Sequential covering of the bad rows; every third row prunes, the others grow."""
    out = DecisionList()
    pruning = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(out.rules) < most_rules and bad[left & ~pruning].any():
        grow, prune = left & ~pruning, left & pruning
        rule = _grow(x[grow], bad[grow], most_conditions)
        if not rule:
            break
        rule = _prune(rule, x[prune], bad[prune])
        hit = covered(rule, x)
        held = hit & prune
        # trusted only while it is precise on rows it wasn't grown on
        if bad[hit & left].mean() < precision or (held.any() and bad[held].mean() < precision) or bad[hit & left].sum() < 3:
            break
        out.rules.append(rule)
        left &= ~hit
    return out


def learn_from(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DecisionList:
    """Learn from ``labels`` (doc_id, quality 0/1): at most ``max_labelled`` of them, in hash order."""
    sample = (labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(max_labelled))
    labelled = (docs.select("doc_id", "text")
                .join(F.broadcast(sample), "doc_id"))  # max_labelled small rows
    stats = with_stats(labelled).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.quality").alias("quality"),
        *[feature(n).alias(n) for n in FEATURES])
    # bounded by the sample; ids that repeat are ordered by their statistics
    rows = sorted(stats.orderBy(F.xxhash64("doc_id")).limit(2 * max_labelled).collect())
    if not rows:
        return DecisionList()
    order = np.random.default_rng(0).permutation(len(rows))
    x = np.array([[r[n] for n in FEATURES] for r in rows], float)[order]
    bad = np.array([r["quality"] == 0 for r in rows])[order]
    return learn(x, bad)


def judged(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """``row``, the statistics, base_failed and kept."""
    failed = base_failed()
    return with_stats(docs).withColumns({"base_failed": failed, "kept": ~failed & rules.kept()})


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of ``docs``."""
    return judged(docs, learn_from(docs, labels)).where("kept").select("row.*")
