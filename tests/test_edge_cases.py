"""Hand fixtures for cases the generated data cannot contain."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pitchlens.functions import columns as C
from pitchlens.functions import score as S
from pitchlens.plans import intermediate as I
from pitchlens.plans import marts as M
from pitchlens.plans import staging as ST
from tests.helpers import fixture, fixtures_df, player_gameweeks_df, players_df


def _by(rows, *keys):
    return sorted(rows, key=lambda r: tuple(r[k] for k in keys))


def test_two_matches_in_one_gameweek_give_two_rows(spark):
    fx = fixtures_df(spark, [
        fixture(1, 5, home=10, away=20, hs=1, as_=0, hour=12),
        fixture(2, 5, home=10, away=30, hs=0, as_=0, hour=18),
    ])
    tp = I.team_performance(ST.stg_fixtures(fx))
    rows = _by([r for r in tp.collect() if r.team_id == 10], "kickoff_time")
    assert len(rows) == 2                     # the join form would give 4
    assert [r.fixture_id for r in rows] == [1, 2]
    assert rows[0].season_points == 3 and rows[1].season_points == 4
    assert rows[1].home_attack_3gw == pytest.approx(0.5)


def test_blank_gameweek_counts_matches_not_gameweeks(spark):
    gws = [1, 2, 4, 5, 6, 7]
    fx = fixtures_df(spark, [fixture(i, gw, home=1, away=2, hs=gw, as_=0) for i, gw in enumerate(gws)])
    tp = I.team_performance(ST.stg_fixtures(fx))
    last = [r for r in tp.collect() if r.team_id == 1 and r.gameweek == 7][0]
    assert last.attack_strength_5gw == pytest.approx((2 + 4 + 5 + 6 + 7) / 5)


def test_lagged_first_row_is_null_and_count_zero(spark):
    players = players_df(spark, [dict(id=1, web_name="a", element_type=3, team=1, status="a")])
    pg = player_gameweeks_df(spark, [dict(element=1, round=1, fixture=1, minutes=90, total_points=5,
                                          kickoff_time=None, yellow_cards=0, red_cards=0, bonus=1)])
    pr = I.player_rolling(ST.stg_player_gameweeks(pg), ST.stg_players(players), lag=1).collect()[0]
    assert pr.form_3gw is None and pr.season_points_before is None and pr.red_rolling_5gw is None
    assert pr.games_played_before == 0


def test_clean_sheet_rate_is_double(spark):
    fx = fixtures_df(spark, [fixture(i, i, home=1, away=2, hs=1, as_=ga) for i, ga in [(1, 0), (2, 1), (3, 2)]])
    tp = I.team_performance(ST.stg_fixtures(fx))
    last = [r for r in tp.collect() if r.team_id == 1 and r.gameweek == 3][0]
    assert last.clean_sheet_rate_5gw == 1 / 3
    assert dict(tp.dtypes)["clean_sheet_rate_5gw"] == "double"


def test_fixture_results(spark):
    fx = fixtures_df(spark, [
        fixture(1, 1, 1, 2, hs=1, as_=1, finished=None),        # neither finished nor upcoming
        fixture(2, 1, 3, 4, hs=None, as_=None, finished=True),  # finished without scores
        fixture(3, 1, 5, 6, hs=2, as_=0, finished=False),       # live score, not finished
        fixture(4, None, 7, 8, finished=False),                 # unscheduled: dropped
    ])
    stg = {r.fixture_id: r for r in ST.stg_fixtures(fx).collect()}
    assert set(stg) == {1, 2, 3}
    assert stg[2].result is None and stg[3].result == "scheduled"
    played = I.team_match_rows(ST.stg_fixtures(fx), finished=True).collect()
    upcoming = I.team_match_rows(ST.stg_fixtures(fx), finished=False).collect()
    assert {r.fixture_id for r in played} == {2} and {r.fixture_id for r in upcoming} == {3}
    assert all(r.match_points == 0 for r in played)


def test_player_filters_and_positions(spark):
    players = players_df(spark, [
        dict(id=1, element_type=1, status="a"), dict(id=2, element_type=5, status="a"),
        dict(id=3, element_type=None, status="a"), dict(id=4, element_type=2, status=None),
        dict(id=5, element_type=2, status="u"),
    ])
    stg = {r.player_id: r for r in ST.stg_players(players).collect()}
    assert set(stg) == {1, 2, 3}
    assert stg[1].position == "GK" and stg[2].position is None and stg[3].position is None
    assert stg[1].chance_of_playing == 100 and stg[1].form == 0.0 and stg[1].total_points == 0


@pytest.mark.parametrize("bad", ["abc", ""])
def test_malformed_number_text_raises(spark, bad):
    players = players_df(spark, [dict(id=1, element_type=1, status="a", form=bad)])
    with pytest.raises(Exception):
        ST.stg_players(players).collect()


def _score(spark, rows, lagged=False):
    df = spark.createDataFrame([Row(**r) for r in rows],
                               "position string, form double, fdr long, vd double, bd double, "
                               "va double, ba double, cs double")
    x = S.ScoreInputs(F.col("position"), F.col("form"), F.col("fdr"),
                      S.opponent_stat(F.col("vd"), F.col("bd")), S.opponent_stat(F.col("va"), F.col("ba")),
                      F.coalesce(F.col("cs"), F.lit(0.0)) if lagged else F.col("cs"))
    fn = S.lagged_pick_score if lagged else S.live_pick_score
    return [r.s for r in df.select(fn(x).alias("s")).collect()]


BASE = dict(position="MID", form=5.0, fdr=3, vd=None, bd=None, va=None, ba=None, cs=0.5)


def test_scores_live_vs_lagged(spark):
    gk = dict(BASE, position="GK", form=4.0, fdr=2, va=1.0)
    assert _score(spark, [gk]) == [17.0]                              # 8 + 4 + 3 + 2
    assert _score(spark, [dict(BASE, form=0.0)]) == [0.0]             # live guard
    assert _score(spark, [dict(BASE, form=0.0)], lagged=True) == [3.0 + 2.0]   # scored
    assert _score(spark, [dict(BASE, fdr=None)]) == [0.0]
    assert _score(spark, [dict(BASE, fdr=None)], lagged=True) == [None]
    d = dict(BASE, position="DEF", cs=None)
    assert _score(spark, [d]) == [None]                               # live: NULL clean-sheet rate
    assert _score(spark, [d], lagged=True) == [10.0 + 3.0 + 2.5]     # lagged: counted as 0
    assert _score(spark, [dict(BASE, position="XX")]) == [None]
    assert _score(spark, [dict(BASE, position=None)], lagged=True) == [None]
    assert _score(spark, [dict(BASE, position=None, form=0.0)]) == [0.0]
    # venue stat, else blended, else 1.0
    assert _score(spark, [dict(BASE, vd=None, bd=1.5)]) == [10.0 + 3.0 + 3.0]
    assert _score(spark, [dict(BASE, vd=None, bd=None)]) == [10.0 + 3.0 + 2.0]


def test_ratio_and_flag(spark):
    df = spark.createDataFrame([(5.0, 0.0, 5.0, 9.9), (5.0, 2.0, 5.0, 10.0), (1.0, 1.0, None, 1.0)],
                               "price double, ppg double, form double, own double")
    rows = df.select(C.ratio_or("price", "ppg", 999.0).alias("c"),
                     S.is_differential(F.col("form"), F.col("own")).alias("d")).collect()
    assert [r.c for r in rows] == [999.0, 2.5, 1.0]
    assert [r.d for r in rows] == [True, False, False]


def test_fixture_difficulty_edges(spark):
    # team 2 has played only at home: its away stats are NULL; last upcoming W10 = own fdr
    fx = fixtures_df(spark, [
        fixture(1, 1, home=2, away=1, hs=2, as_=1),
        fixture(2, 2, home=1, away=2, finished=False, hd=2, ad=5),
        fixture(3, 3, home=2, away=1, finished=False, hd=4, ad=3),
    ])
    stg = ST.stg_fixtures(fx)
    teams = spark.createDataFrame([(1, "One"), (2, "Two")], "team_id long, team_name string")
    fd = I.fixture_difficulty(stg, I.latest_team_stats(I.team_performance(stg)), teams)
    rows = {(r.team_id, r.gameweek): r for r in fd.collect()}
    # team 1 is at home in gw 2 -> opponent 2 plays away -> 2's away stats (none yet)
    assert rows[(1, 2)].opponent_venue_attack is None
    assert rows[(1, 2)].opponent_attack == 2.0
    assert rows[(2, 2)].opponent_venue_attack is None  # team 1 has no home match
    assert rows[(1, 3)].avg_fdr_next_3 == 3.0 and rows[(1, 2)].avg_fdr_next_3 == 2.5
    assert rows[(1, 2)].fixture_order == 1 and rows[(1, 3)].fixture_order == 2


def test_match_json(spark):
    df = spark.createDataFrame([
        (1, 1, None, "FINISHED", '{"id": 5, "name": "A"}', '{"id": 6, "name": "B"}',
         '{"winner": null, "fullTime": {"home": 1, "away": 1}}'),
        (2, 1, None, "TIMED", None, None, None),
        (3, 1, None, "POSTPONED", None, None, None),
        (4, 1, None, "FINISHED", '{"id": 7}', '{"id": 8}', '{"winner": "AWAY_TEAM", "fullTime": {"home": 0, "away": 2}}'),
    ], "id long, matchday long, utc_date timestamp_ntz, status string, home_team string, away_team string, score string")
    rows = {r.match_id: r for r in ST.stg_matches(df).collect()}
    assert set(rows) == {1, 2, 4}
    assert rows[1].result == "scheduled" and rows[1].home_goals == 1 and rows[1].home_team_fd_id == 5
    assert rows[2].result == "scheduled" and rows[2].home_team_name is None
    assert rows[4].result == "away_win" and rows[4].away_goals == 2 and rows[4].home_goals_ht is None


def _backtest_inputs(spark):
    # player 1 currently in team 1, but played gw 1-2 for team 3 (transfer)
    fx = fixtures_df(spark, [
        fixture(10 + gw, gw, home=1, away=2, hs=1, as_=0) for gw in range(1, 7)
    ] + [fixture(20 + gw, gw, home=3, away=4, hs=2, as_=2) for gw in range(1, 7)])
    players = players_df(spark, [dict(id=1, web_name="p", element_type=3, team=1, status="a")])
    pg = player_gameweeks_df(spark, [
        dict(element=1, round=gw, fixture=(20 if gw <= 2 else 10) + gw, was_home=True, minutes=90,
             total_points=gw, kickoff_time=None, yellow_cards=0, red_cards=0, bonus=0)
        for gw in range(1, 7)])
    stg_fx = ST.stg_fixtures(fx)
    pr = I.player_rolling(ST.stg_player_gameweeks(pg), ST.stg_players(players), lag=1)
    return pr, stg_fx, M.team_stats_by_gameweek(I.team_performance(stg_fx, lag=1))


def test_backtest_current_team_vs_played_fixture(spark):
    pr, stg_fx, tp = _backtest_inputs(spark)
    default = {r.gameweek: r for r in M.backtest_picks(pr, stg_fx, tp, first_gameweek=1).collect()}
    fixture_based = {r.gameweek: r for r in
                     M.backtest_picks(pr, stg_fx, tp, on_fixture=True, first_gameweek=1).collect()}
    assert all(r.team_id == 1 for r in default.values())           # reference behaviour
    assert fixture_based[1].team_id == 3 and fixture_based[3].team_id == 1
    assert default[2].form_3gw == 1.0 and default[2].points_per_game_before == 1.0
    assert default[1].pick_score is None                            # no form before gw 1
    assert sorted(M.backtest_picks(pr, stg_fx, tp).select("gameweek").toPandas().gameweek) == [5, 6]


def test_top_k_tie_lowest_id_first(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 2.0), (4, None)], "player_id long, pick_score double")
    assert [r.player_id for r in M.weekly_top_picks(df, k=3).collect()] == [1, 2, 3]


def test_column_helpers(spark):
    labels = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,)], "fdr long").select(
        C.bucket_label("fdr").alias("l")).collect()
    assert [r.l for r in labels] == ["easy", "easy", "medium", "hard", "hard", None]
    v = spark.createDataFrame([("home",), ("away",), ("n",)], "venue string").select(
        C.venue_switch("venue", F.lit(1), F.lit(2)).alias("v")).collect()
    assert [r.v for r in v] == [1, 2, None]
    pts = spark.createDataFrame([("home_win",), ("draw",), ("away_win",), (None,)], "r string").select(
        C.result_points("r", "home_win").alias("p")).collect()
    assert [r.p for r in pts] == [3, 1, 0, 0]


BROKEN = ['{"id": 5, "name": "A"', "", "  ", "not json"]


@pytest.mark.parametrize("text", BROKEN)
@pytest.mark.parametrize("column", ["home_team", "score"])
def test_a_broken_match_document_raises(spark, text, column):
    row = {"home_team": '{"id": 5}', "away_team": '{"id": 6}', "score": '{"winner": null}', column: text}
    df = spark.createDataFrame([(1, 1, None, "FINISHED", row["home_team"], row["away_team"], row["score"])],
                               "id long, matchday long, utc_date timestamp_ntz, status string, "
                               "home_team string, away_team string, score string")
    with pytest.raises(Exception):
        ST.stg_matches(df).collect()


@pytest.mark.parametrize("text", BROKEN)
def test_a_broken_document_has_no_path(spark, text):
    df = spark.createDataFrame([('{"k": 1}',), (None,), ('{"k": null}',), ("{}",)], "d string")
    assert [r.k for r in df.select(C.json_int("d", "$.k").alias("k")).collect()] == [1, None, None, None]
    with pytest.raises(Exception):
        df.union(spark.createDataFrame([(text,)], "d string")).select(C.json_text("d", "$.k").alias("k")).collect()


def test_latest_value_may_be_null(spark):
    """D1 takes the last row's value, NULL too; D2 the last row where its probe is set."""
    from pitchlens.operators.latest import latest_values

    df = spark.createDataFrame([(1, 1, 5.0, 7.0), (1, 2, None, 8.0), (1, 3, None, None), (2, 1, None, None)],
                               "k long, t long, a double, b double")
    rows = {r.k: r for r in latest_values(df, ["k"], ["t"], {"a": "a", "a_when_b": ("a", "b"), "b": ("b", "b")}).collect()}
    assert (rows[1].a, rows[1].a_when_b, rows[1].b) == (None, None, 8.0)
    assert (rows[2].a, rows[2].a_when_b, rows[2].b) == (None, None, None)


def test_seasons_start_anew(spark):
    one = fixtures_df(spark, [fixture(i, i, home=1, away=2, hs=1, as_=0) for i in (1, 2, 3)])
    both = one.withColumn("season", F.lit(1)).unionByName(one.withColumn("season", F.lit(2)))
    tp = I.team_performance(ST.stg_fixtures(both, ["season"]), season=["season"]).where("team_id = 1")
    points = sorted((r.season, r.gameweek, r.season_points) for r in tp.collect())
    assert points == [(s, g, 3 * g) for s in (1, 2) for g in (1, 2, 3)]
    stats = I.latest_team_stats(tp, ["season"]).collect()
    assert sorted((r.season, r.team_id) for r in stats) == [(1, 1), (2, 1)]
