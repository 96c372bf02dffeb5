"""Sums of doubles that don't depend on the order of adding: the nearest double of the
exact sum.

A column's values lie between two powers of two (one aggregation finds them).  The
bits from the lowest to the highest are cut into limbs of ``WIDTH`` bits, each an
exact integer, positive or negative, of every value: a handful for values of one
kind, 88 for the whole range of doubles.  Limbs are summed as BIGINT, which is exact
however rows are split and which any aggregate or window can do (a limb's sum fits
up to 2^39 rows); the sums are put together at the end: carried into digits, of
which the highest four and a mark for lower ones round once, to the nearest
double, ties to even.

Infinities and NaN have no limbs; where a column holds some, their plain sum (an
infinity, or NaN) is the result of every sum that meets them.  A sum beyond the
largest double is an infinity.  Null values count nothing; a sum of nothing is null.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDTH = 24
BASE = 1 << WIDTH
LOWEST = -1074  # exponent of the smallest double


def scaled(x: Column, exponent: int) -> Column:
    """x * 2**exponent, in steps whose factors are doubles."""
    while exponent:
        step = max(-1000, min(1000, exponent))
        x, exponent = x * F.lit(math.ldexp(1.0, step)), exponent - step
    return x


@dataclass(frozen=True)
class Limbs:
    """How a column's values are cut: ``count`` limbs from 2**``low`` on; ``special`` where it
    holds infinities or NaN."""

    low: int
    count: int
    special: bool

    def inputs(self, x: Column) -> list[Column]:
        """What to add up, per value."""
        x = x.cast("double")
        finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))
        limbs = []
        for k in range(self.count):
            y = scaled(x, -(self.low + WIDTH * k))
            # a value of 77 bits and more above this limb's place has none of its 53 bits in it
            limb = F.when(F.abs(y) < F.lit(math.ldexp(1.0, 53 + WIDTH)), (y - y % F.lit(1.0)) % F.lit(float(BASE))).otherwise(F.lit(0.0))
            limbs.append(F.when(finite, limb.cast("long")).when(x.isNotNull(), F.lit(0).cast("long")))
        return limbs + ([F.when(~finite, x)] if self.special else [])

    def total(self, sums: Sequence[Column]) -> Column:
        """The nearest double of the sum, from the summed inputs."""
        limbs = F.array(*sums[:self.count])
        carried = lambda sign: F.aggregate(
            limbs, F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<long>").alias("digits")),
            lambda s, x: F.struct(F.shiftright(s.carry + sign * x, WIDTH).alias("carry"),
                                  F.concat(s.digits, F.array((s.carry + sign * x).bitwiseAND(F.lit(BASE - 1).cast("long")))).alias("digits")))
        # the sign of the sum is that of the carry out of the highest limb
        sign = F.when(carried(F.lit(1).cast("long")).carry < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
        # highest digit first; the carry is two more
        digits = F.transform(F.array(carried(sign)), lambda s: F.reverse(F.concat(
            s.digits, F.array(s.carry.bitwiseAND(F.lit(BASE - 1).cast("long")), F.shiftright(s.carry, WIDTH)))))[0]

        def rounded(d: Column) -> Column:
            first = F.aggregate(d, F.struct(F.lit(0).alias("at"), F.lit(False).alias("met")),
                                lambda s, x: F.struct((s.at + F.when(s.met | (x != 0), 0).otherwise(1)).alias("at"), (s.met | (x != 0)).alias("met"))).at
            top = F.aggregate(F.slice(F.concat(d, F.array_repeat(F.lit(0).cast("long"), 3)), F.least(first, F.lit(self.count + 1)) + 1, 4),
                              F.lit(0).cast("decimal(38,0)"), lambda s, x: (s * F.lit(BASE) + x).cast("decimal(38,0)"))
            lower = F.exists(F.slice(F.concat(d, F.array_repeat(F.lit(0).cast("long"), 4)), F.least(first, F.lit(self.count + 1)) + 5, self.count + 2), lambda x: x != 0)
            marked = (top * F.lit(2) + F.when(lower, 1).otherwise(0)).cast("decimal(38,0)")
            # text gives the nearest double; the last of the four digits has place count - 2 - first
            near = marked.cast("string").cast("double")
            place = F.lit(self.low - 1) + F.lit(WIDTH) * (F.lit(self.count - 2) - first)
            half = F.floor(place / 2)
            return near * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), place - half)

        exact = sign.cast("double") * F.transform(F.array(digits), rounded)[0]
        exact = F.when(sums[0].isNotNull(), exact)
        return F.coalesce(sums[self.count], exact) if self.special else exact


def limbs_of(df: DataFrame, columns: Sequence[Column]) -> list[Limbs]:
    """How to cut each column: one aggregation over ``df``, two numbers a column."""
    stats = []
    for i, c in enumerate(columns):
        x = c.cast("double")
        finite = F.when(~F.isnan(x) & (F.abs(x) != F.lit(math.inf)) & (x != 0), F.abs(x))
        stats += [F.min(finite).alias(f"low{i}"), F.max(finite).alias(f"high{i}"),
                  F.coalesce(F.max(F.isnan(x) | (F.abs(x) == F.lit(math.inf))), F.lit(False)).alias(f"special{i}")]
    found = df.agg(*stats).first()
    out = []
    for i in range(len(columns)):
        low, high = found[f"low{i}"], found[f"high{i}"]
        if low is None:
            out.append(Limbs(0, 1, found[f"special{i}"]))
            continue
        bottom = max(math.frexp(low)[1] - 53, LOWEST)
        out.append(Limbs(bottom, -(-(math.frexp(high)[1] - bottom) // WIDTH), found[f"special{i}"]))
    return out


def exact_sum(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Per key the nearest double of the exact sum of a column."""
    limbs, = limbs_of(df, [F.col(column)])
    names = [f"__pl_l{k}" for k in range(limbs.count + limbs.special)]
    sums = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in zip(names, limbs.inputs(F.col(column)), strict=True)])
    return sums.select(*keys, limbs.total([F.col(n) for n in names]).alias(out))
