"""Properties of the operators on driver-derived data."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import Window

from pitchlens.operators.rolling import Agg, ahead, cumulative, rolling, rolling_by_subgroup, sequence_number, trailing
from pitchlens.operators.spread import spread_window
from pitchlens.plans.intermediate import team_match_rows
from pitchlens.plans.league_views import league_inputs
from pitchlens.plans.models import LeagueModels
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    return LeagueModels(league_inputs(spark, SF_SMALL))


def test_lag1_equals_previous_lag0(models):
    live, lagged = models.team_performance, models.team_performance_lagged
    w = Window.partitionBy("team_id").orderBy("gameweek", "kickoff_time", "fixture_id")
    prev = live.select("team_id", "fixture_id", *[F.lag(c).over(w).alias(c) for c in
                       ("form_5gw", "season_points", "attack_strength_5gw")])
    joined = lagged.alias("l").join(prev.alias("p"), ["team_id", "fixture_id"])
    bad = joined.where(~F.col("l.form_5gw").eqNullSafe(F.col("p.form_5gw"))
                       | ~F.col("l.season_points").eqNullSafe(F.col("p.season_points"))
                       | ~F.col("l.attack_strength_5gw").eqNullSafe(F.col("p.attack_strength_5gw")))
    assert joined.count() == lagged.count()
    assert bad.count() == 0


def test_two_sided_doubles_rows_and_balances_goals(models):
    fx = models.stg_fixtures.where("finished")
    sides = team_match_rows(models.stg_fixtures, finished=True)
    assert sides.count() == 2 * fx.count()
    tot = sides.agg(F.sum("goals_for").alias("f"), F.sum("goals_against").alias("a")).collect()[0]
    assert tot.f == tot.a


def test_subgroup_window_equals_join_form(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    order = ["ts", "event_id"]
    got = rolling_by_subgroup(ev, ["user_id"], "event_type", order,
                              {"v3": ("purchase", Agg("avg", "value", trailing(3)))})
    only = rolling(ev.where(F.col("event_type") == "purchase"), ["user_id"], order,
                   {"v3": Agg("avg", "value", trailing(3))}).select("event_id", F.col("v3").alias("j3"))
    cmp = got.join(only, "event_id", "left")
    assert cmp.where(~F.col("v3").eqNullSafe(F.col("j3"))).count() == 0


def test_lookahead_last_row_is_own_value(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    out = rolling(ev, ["user_id"], ["ts", "event_id"], {"n3": Agg("avg", "value", ahead(3))})
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    last = out.withColumn("r", F.row_number().over(w)).where("r = 1")
    assert last.where(F.col("n3") != F.col("value")).count() == 0


def test_ticker_has_at_most_n_per_team(models):
    counts = models.fixture_ticker.groupBy("team_id").count()
    assert counts.agg(F.max("count")).collect()[0][0] <= 8


def test_fixture_ticker_sorted(models):
    rows = [(r.team_id, r.fixture_order) for r in models.fixture_ticker.select("team_id", "fixture_order").collect()]
    assert rows == sorted(rows)


ORDER = ["o_orderdate", "o_orderkey"]
KEYS = {
    "one key": "1",
    "few keys and NULL": "CASE WHEN o_custkey % 5 <> 0 THEN o_custkey % 40 END",
    "a key per row": "o_orderkey",
}


def _orders(spark, key):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet").select(
        F.expr(key).alias("k"), "o_orderkey", "o_orderdate", "o_totalprice", F.col("o_totalprice").cast("decimal(15,2)").alias("m"))


@pytest.mark.parametrize("partitions", [1, 7, 400])
@pytest.mark.parametrize("key", sorted(KEYS))
def test_spread_windows_equal_plain_windows(spark, key, partitions):
    """Whatever share of the rows a key has, and with ranges larger and smaller than
    the frames (400 ranges: 3 or 4 rows each)."""
    od = _orders(spark, KEYS[key])
    aggs = {
        "a3": Agg("avg", "o_totalprice", trailing(3)), "a5l": Agg("avg", "o_totalprice", trailing(5, lag=1)),
        "s5": Agg("sum", "m", trailing(5)), "c": Agg("sum", "m", cumulative()),
        "cl": Agg("sum", "m", cumulative(lag=1)), "n": Agg("count", None, cumulative()),
        "nl": Agg("count", None, cumulative(lag=1)), "ahead5": Agg("avg", "o_totalprice", ahead(5)),
    }
    plain = sequence_number(od, ["k"], ORDER, "seq", aggs)
    split = spread_window(od, ["k"], ORDER, aggs, "seq", partitions)
    assert [(f.name, f.dataType) for f in plain.schema] == [(f.name, f.dataType) for f in split.schema]
    assert split.count() == plain.count()
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


@pytest.mark.parametrize("aggs", [
    {"f": Agg("avg", "o_totalprice", ahead(5))}, {"p": Agg("avg", "o_totalprice", trailing(4, lag=1))},
    {"n": Agg("count", None, cumulative())}])
def test_spread_windows_of_one_kind(spark, aggs):
    od = _orders(spark, KEYS["few keys and NULL"])
    plain = rolling(od, ["k"], ORDER, aggs)
    split = spread_window(od, ["k"], ORDER, aggs, partitions=50)
    assert plain.exceptAll(split).count() == 0 and split.count() == plain.count()


def test_running_sums_of_doubles_are_exact(spark):
    """Bit-equal to the rule (the nearest double of the exact sum), however the rows are split."""
    from fractions import Fraction

    od = _orders(spark, KEYS["one key"]).withColumn("v", F.col("o_totalprice") / F.lit(7.0))
    aggs = {"c": Agg("sum", "v", cumulative()), "m": Agg("avg", "v", cumulative(lag=1))}
    got = [{r.o_orderkey: (r.c, r.m) for r in spread_window(od, ["k"], ORDER, aggs, partitions=n).collect()} for n in (1, 13)]
    assert got[0] == got[1]
    total, want = Fraction(0), {}
    for r in od.orderBy(*ORDER).collect():
        total += Fraction(r.v)
        want[r.o_orderkey] = float(total)
    assert {k: c for k, (c, _) in got[0].items()} == want


def test_cut_before_lookahead_is_exact(models):
    full = models.fixture_difficulty.where(F.col("fixture_order") <= 8)
    head = models.upcoming_head(8)
    assert head.count() == full.count()
    assert head.exceptAll(full).count() == 0


def test_first_n_with_ahead_on_a_hot_key(spark):
    from pitchlens.operators.rolling import first_n_with_ahead

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("user_id", F.lit(7))
    aggs = {"n3": Agg("avg", "value", ahead(3)), "p2": Agg("avg", "value", trailing(2))}
    order = ["ts", "event_id"]
    full = sequence_number(ev, ["user_id"], order, "seq", aggs).where("seq <= 8")
    head = first_n_with_ahead(ev, ["user_id"], order, 8, "seq", aggs)
    assert head.count() == 8 and head.exceptAll(full).count() == 0
