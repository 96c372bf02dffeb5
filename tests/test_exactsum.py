"""Sums of doubles: the nearest double of the exact sum, whatever the split."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from pitchlens.operators.exactsum import exact_sum, limbs_of
from pitchlens.operators.rolling import Agg, cumulative
from pitchlens.operators.spread import spread_window


def nearest(values):
    finite = [v for v in values if v is not None]
    if not finite:
        return None
    if any(math.isnan(v) or math.isinf(v) for v in finite):
        return sum(v for v in finite if math.isnan(v) or math.isinf(v))
    total = sum(map(Fraction, finite))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def groups(rng):
    """Lists of values: prices, cancelling ones, ties, subnormal and huge ones, specials."""
    tie = 2.0 ** 53
    some = [[round(rng.uniform(0, 1e5), 2) for _ in range(40)] for _ in range(5)]
    some += [[1e300, 1e-20, -1e300], [1e-20, 1e300, 7.0, -1e300], [tie, 1.0], [tie, 1.0, 2.0 ** -40], [tie, 1.0, -(2.0 ** -40)], [-tie, -1.0],
             [tie + 2, 1.0], [5e-324] * 3, [2.2e-308, -2.1e-308], [0.0, -0.0], [None, None], [None, 1.5], [1e308] * 3, [-1e308] * 2, [0.1] * 10,
             [1.7976931348623157e308, -1.7976931348623157e308, 5e-324], [2.0 ** 1000, -(2.0 ** 1000), 2.0 ** 500, 2.0 ** -500]]
    some += [[math.ldexp(rng.uniform(-1, 1), rng.randint(-1070, 1000)) for _ in range(rng.randint(1, 9))] for _ in range(60)]
    some += [[math.ldexp(rng.uniform(-1, 1), rng.randint(-60, 60)) for _ in range(rng.randint(1, 30))] for _ in range(60)]
    return some


@pytest.mark.parametrize("special", [False, True])
def test_sums_are_correctly_rounded(spark, special):
    rng = random.Random(1)
    lists = groups(rng) + ([[math.inf, 1.0], [math.inf, -math.inf], [math.nan, 2.0], [-math.inf]] if special else [])
    rows = [(k, v) for k, values in enumerate(lists) for v in values]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, v double").repartition(4)
    got = {r["k"]: r["s"] for r in exact_sum(df, ["k"], "v", "s").collect()}
    for k, values in enumerate(lists):
        assert same(got[k], nearest(values)), (values, got[k], nearest(values))


def test_values_of_one_kind_take_few_limbs(spark):
    df = spark.createDataFrame([(0.01,), (99999.99,), (0.0,), (None,)], "v double")
    assert limbs_of(df, [F.col("v")])[0].count <= 4
    assert limbs_of(df.where("v = 0"), [F.col("v")])[0].count == 1
    assert exact_sum(df.where("v = 0"), [], "v", "s").collect()[0]["s"] == 0.0
    assert exact_sum(df.limit(0), [], "v", "s").collect()[0]["s"] is None
    floats = spark.createDataFrame([(0.1,), (0.2,)], "v float")
    assert exact_sum(floats, [], "v", "s").collect()[0]["s"] == nearest([r["v"] for r in floats.collect()])


@pytest.mark.parametrize("partitions", [1, 9])
def test_running_sums_of_any_doubles(spark, partitions):
    rng = random.Random(2)
    values = [1e300, 1e-20, 3.0, -1e300, 0.1, None, 2.0 ** 53, 1.0] + [math.ldexp(rng.uniform(-1, 1), rng.randint(-80, 80)) for _ in range(40)]
    rows = [("a" if rng.random() < 0.8 else "b", t, v) for t, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    out = spread_window(df, ["k"], ["t"], {"l": Agg("sum", "v", cumulative(lag=1)), "m": Agg("avg", "v", cumulative())}, partitions=partitions)
    for r in out.collect():
        before = [v for k, t, v in rows if k == r["k"] and t < r["t"]]
        upto = before + [r["v"]]
        assert same(r["l"], nearest(before)), (r, nearest(before))
        n = sum(v is not None for v in upto)
        assert same(r["m"], nearest(upto) / n if n else None)
