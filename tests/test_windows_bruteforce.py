"""Window operators against a pure-Python brute force on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitchlens.operators.rolling import Agg, ahead, cumulative, first_n_with_ahead, sequence_number, trailing
from pitchlens.operators.spread import spread_window

AGGS = {
    "t3": Agg("avg", "v", trailing(3)), "t2l": Agg("sum", "v", trailing(2, lag=1)),
    "c": Agg("sum", "v", cumulative()), "cl": Agg("sum", "v", cumulative(lag=1)),
    "n": Agg("count", None, cumulative()), "nl": Agg("count", None, cumulative(lag=1)),
    "a3": Agg("avg", "v", ahead(3)),
}


def brute(rows):
    """rows: (k, t, v) with unique (k, t); returns {(k, t): {col: value}}."""
    out = {}
    by_key = {}
    for k, t, v in rows:
        by_key.setdefault(k, []).append((t, v))
    for k, items in by_key.items():
        items.sort()
        vals = [v for _, v in items]
        for i, (t, _) in enumerate(items):
            def frame(lo, hi):
                lo, hi = max(lo, 0), min(hi, len(vals) - 1)
                return [x for x in vals[lo:hi + 1] if x is not None] if lo <= hi else []

            def avg(xs):
                return sum(xs) / len(xs) if xs else None

            def tot(xs):
                return sum(xs) if xs else None
            out[(k, t)] = {
                "seq": i + 1,
                "t3": avg(frame(i - 2, i)), "t2l": tot(frame(i - 2, i - 1)),
                "c": tot(frame(0, i)), "cl": tot(frame(0, i - 1)),
                "n": i + 1, "nl": i, "a3": avg(frame(i, i + 2)),
            }
    return out


row_lists = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 9))),
    min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]))


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(float(a) - float(b)) < 1e-9


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=row_lists, width=st.integers(1, 15))
def test_windows_match_brute_force(spark, rows, width):
    df = spark.createDataFrame(rows, "k long, t long, v long")
    expected = brute(rows)
    plain = sequence_number(df, ["k"], ["t"], "seq", AGGS)
    split = spread_window(df, ["k"], ["t"], AGGS, "seq", partitions=width)
    for result in (plain, split):
        got = {(r.k, r.t): r.asDict() for r in result.collect()}
        assert set(got) == set(expected)
        for key, exp in expected.items():
            for col, val in exp.items():
                assert _close(got[key][col], val), (key, col, got[key][col], val)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=row_lists, n=st.integers(1, 6))
def test_first_n_with_ahead_matches_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, "k long, t long, v long")
    expected = {key: e for key, e in brute(rows).items() if e["seq"] <= n}
    got = {(r.k, r.t): r for r in first_n_with_ahead(df, ["k"], ["t"], n, "seq",
                                                     {"a3": AGGS["a3"], "t3": AGGS["t3"]}).collect()}
    assert set(got) == set(expected)
    for key, exp in expected.items():
        assert got[key].seq == exp["seq"]
        assert _close(got[key].a3, exp["a3"]) and _close(got[key].t3, exp["t3"])
