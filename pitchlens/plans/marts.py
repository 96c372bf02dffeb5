"""Pick scores, fixture ticker, backtest picks, weekly top picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.functions import columns as C
from pitchlens.functions import score as S
from pitchlens.operators.latest import first_rows
from pitchlens.plans.intermediate import same, team_match_rows

# Eligibility of a live pick and the ticker horizon.
MIN_CHANCE_OF_PLAYING = 50
TICKER_FIXTURES = 8
BACKTEST_FIRST_GAMEWEEK = 5
NO_POINTS_COST = 999.0

PLAYER_PICKS_OUTPUT = [
    "player_id", "player_name", "position", "team_name", "team_short",
    "price", "ownership_pct", "transfers_in_gw", "transfers_out_gw", "net_transfers",
    "total_points", "minutes", "goals_scored", "assists", "clean_sheets", "defensive_contribution", "bonus",
    "form", "points_per_game", "expected_points_next", "xg", "xa", "xgi", "ict_index",
    "value_form", "value_season", "cost_per_point",
    "next_gw", "next_opponent", "next_venue", "next_fdr", "avg_fdr_next_3", "avg_fdr_next_5",
    "opponent_form", "opponent_attack", "opponent_defense_weakness", "opponent_clean_sheet_rate",
    "opponent_venue_attack", "opponent_venue_defense", "opponent_venue_cs_rate",
    "team_form", "team_attack", "team_defense_weakness", "team_cs_rate",
    "chance_of_playing", "status", "news", "pick_score", "is_differential",
]


def player_picks(stg_players: DataFrame, stg_teams: DataFrame, fixture_diff: DataFrame,
                 team_stats: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """One row per eligible player with next-fixture context and score.

    Every right side has one row per team (the next fixture is the row with
    fixture_order 1), so all three joins are lookups the planner can
    broadcast when their measured size allows it.
    """
    p = stg_players.where((F.col("minutes") > F.lit(0))
                          & (F.col("chance_of_playing") >= F.lit(MIN_CHANCE_OF_PLAYING))).alias("p")
    t = stg_teams.alias("t")
    nf = fixture_diff.where(F.col("fixture_order") == F.lit(1)).alias("nf")
    tp = team_stats.alias("tp")
    j = (p.join(t, same("p", "t", season, team_id="team_id"), "left")
          .join(nf, same("p", "nf", season, team_id="team_id"), "left")
          .join(tp, same("p", "tp", season, team_id="team_id"), "left"))
    x = S.ScoreInputs(
        position=F.col("p.position"),
        form=F.col("p.form"),
        fdr=F.col("nf.fdr"),
        opp_defense=S.opponent_stat(F.col("nf.opponent_venue_defense"), F.col("nf.opponent_defense_weakness")),
        opp_attack=S.opponent_stat(F.col("nf.opponent_venue_attack"), F.col("nf.opponent_attack")),
        clean_sheet=F.col("tp.clean_sheet_rate_5gw"),
    )
    return j.select(
        *[F.col(f"p.{c}").alias(c) for c in season],
        "p.player_id", "p.player_name", "p.position", "t.team_name",
        F.col("t.short_name").alias("team_short"),
        "p.price", "p.ownership_pct", "p.transfers_in_gw", "p.transfers_out_gw",
        C.difference("p.transfers_in_gw", "p.transfers_out_gw").alias("net_transfers"),
        "p.total_points", "p.minutes", "p.goals_scored", "p.assists", "p.clean_sheets",
        "p.defensive_contribution", "p.bonus",
        "p.form", "p.points_per_game", "p.expected_points_next", "p.xg", "p.xa", "p.xgi", "p.ict_index",
        "p.value_form", "p.value_season",
        C.ratio_or("p.price", "p.points_per_game", NO_POINTS_COST).alias("cost_per_point"),
        F.col("nf.gameweek").alias("next_gw"),
        F.col("nf.opponent_name").alias("next_opponent"),
        F.col("nf.venue").alias("next_venue"),
        F.col("nf.fdr").alias("next_fdr"),
        "nf.avg_fdr_next_3", "nf.avg_fdr_next_5",
        "nf.opponent_form", "nf.opponent_attack", "nf.opponent_defense_weakness",
        "nf.opponent_clean_sheet_rate", "nf.opponent_venue_attack", "nf.opponent_venue_defense",
        "nf.opponent_venue_cs_rate",
        F.col("tp.form_5gw").alias("team_form"),
        F.col("tp.attack_strength_5gw").alias("team_attack"),
        F.col("tp.defense_weakness_5gw").alias("team_defense_weakness"),
        F.col("tp.clean_sheet_rate_5gw").alias("team_cs_rate"),
        "p.chance_of_playing", "p.status", "p.news",
        S.live_pick_score(x).alias("pick_score"),
        S.is_differential(F.col("p.form"), F.col("p.ownership_pct")).alias("is_differential"),
    )


def fixture_ticker(fixture_diff: DataFrame, stg_teams: DataFrame, horizon: int = TICKER_FIXTURES,
                   season: Sequence[str] = ()) -> DataFrame:
    """The next ``horizon`` fixtures of every team, labelled and sorted."""
    fd = fixture_diff.where(F.col("fixture_order") <= F.lit(horizon)).alias("fd")
    t = stg_teams.alias("t")
    return (fd.join(t, same("fd", "t", season, team_id="team_id"), "left")
              .select(*[F.col(f"fd.{c}").alias(c) for c in season], "fd.team_id", "t.team_name", "t.short_name", "fd.gameweek", "fd.fixture_order",
                      "fd.opponent_name", "fd.venue", "fd.fdr", "fd.opponent_form", "fd.opponent_attack",
                      "fd.opponent_defense_weakness", "fd.avg_fdr_next_3", "fd.avg_fdr_next_5",
                      C.bucket_label("fd.fdr").alias("difficulty_label"))
              .orderBy(*season, F.col("team_id").asc_nulls_last(), F.col("fixture_order").asc_nulls_last()))


def weekly_top_picks(picks: DataFrame, k: int = 10) -> DataFrame:
    """The k best picks; ties broken by player id (a top-k, not a sort)."""
    return picks.orderBy(F.col("pick_score").desc_nulls_last(), F.col("player_id").asc()).limit(k)


TEAM_STATS_BY_GAMEWEEK = [
    "form_5gw", "attack_strength_5gw", "defense_weakness_5gw", "clean_sheet_rate_5gw",
    "home_attack_3gw", "home_defense_3gw", "home_cs_rate_3gw",
    "away_attack_3gw", "away_defense_3gw", "away_cs_rate_3gw",
]

BACKTEST_OUTPUT = [
    "player_id", "player_name", "position", "team_id", "gameweek", "total_points", "minutes",
    "price", "selected_by", "form_3gw", "form_5gw", "xgi_rolling_3gw", "xgc_rolling_3gw",
    "defcon_rolling_3gw", "bonus_rolling_5gw", "ict_rolling_3gw", "yellow_rolling_5gw",
    "season_points_before", "games_played_before", "fdr", "venue", "opponent_id",
    "opponent_form", "opponent_attack", "opponent_defense_weakness", "opponent_clean_sheet_rate",
    "opponent_venue_attack", "opponent_venue_defense", "opponent_venue_cs_rate", "team_cs_rate",
    "pick_score", "points_per_game_before",
]


def team_stats_by_gameweek(team_perf_lagged: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """D3: one row per (team, gameweek); with two matches in a gameweek the
    away row wins (venue ascending), then kickoff and fixture id."""
    first = first_rows(team_perf_lagged, [*season, "team_id", "gameweek"],
                       [F.col("venue").asc_nulls_last(), F.col("kickoff_time").asc_nulls_last(),
                        F.col("fixture_id").asc_nulls_last()])
    return first.select(*season, "team_id", "gameweek", *TEAM_STATS_BY_GAMEWEEK)


def backtest_picks(player_rolling_lagged: DataFrame, stg_fixtures: DataFrame, gameweek_stats: DataFrame,
                   on_fixture: bool = False, first_gameweek: int = BACKTEST_FIRST_GAMEWEEK,
                   season: Sequence[str] = ()) -> DataFrame:
    """Pick scores for every past appearance from pre-match data only.

    Default join (J3) is on (team, gameweek) like the reference; with
    ``on_fixture=True`` the appearance joins its own fixture and side, which
    removes the fan-out of double gameweeks and follows transferred players.
    The warm-up filter runs after the windows (they are computed upstream).
    ``gameweek_stats`` (``team_stats_by_gameweek``) is read for both sides; the two
    reads prune different columns, so hand in a stored table to compute it once.
    """
    fc = team_match_rows(stg_fixtures, True, season).select(
        *season, "team_id", "opponent_id", "gameweek", "fdr", "venue", "fixture_id").alias("fc")
    pr = player_rolling_lagged.alias("pr")
    opp, own = gameweek_stats.alias("opp"), gameweek_stats.alias("own")
    if on_fixture:
        side = F.when(F.col("pr.was_home"), F.lit("home")).otherwise(F.lit("away"))
        cond = same("pr", "fc", season, fixture_id="fixture_id") & (F.col("fc.venue") == side)
        team_col = F.col("fc.team_id")
    else:
        cond = same("pr", "fc", season, team_id="team_id", gameweek="gameweek")
        team_col = F.col("pr.team_id")
    # own-team lookup first: it joins on the keys of the first join, so a
    # sort-merge plan reuses that partitioning; the opponent lookup shuffles once
    j = (pr.join(fc, cond, "inner")
           .join(own, (team_col == F.col("own.team_id")) & same("pr", "own", season, gameweek="gameweek"), "left")
           .join(opp, same("fc", "opp", season, opponent_id="team_id", gameweek="gameweek"), "left"))
    venue = F.col("fc.venue")
    x = S.ScoreInputs(
        position=F.col("pr.position"),
        form=F.col("pr.form_3gw"),
        fdr=F.col("fc.fdr"),
        opp_defense=S.opponent_stat(C.venue_switch(venue, "opp.away_defense_3gw", "opp.home_defense_3gw"),
                                    F.col("opp.defense_weakness_5gw")),
        opp_attack=S.opponent_stat(C.venue_switch(venue, "opp.away_attack_3gw", "opp.home_attack_3gw"),
                                   F.col("opp.attack_strength_5gw")),
        clean_sheet=F.coalesce(F.col("own.clean_sheet_rate_5gw"), F.lit(0.0)),
    )
    out = j.select(
        *[F.col(f"pr.{c}").alias(c) for c in season],
        "pr.player_id", "pr.player_name", "pr.position", team_col.alias("team_id"), "pr.gameweek",
        "pr.total_points", "pr.minutes", "pr.price", "pr.selected_by",
        "pr.form_3gw", "pr.form_5gw", "pr.xgi_rolling_3gw", "pr.xgc_rolling_3gw", "pr.defcon_rolling_3gw",
        "pr.bonus_rolling_5gw", "pr.ict_rolling_3gw", "pr.yellow_rolling_5gw",
        "pr.season_points_before", "pr.games_played_before",
        "fc.fdr", "fc.venue", "fc.opponent_id",
        F.col("opp.form_5gw").alias("opponent_form"),
        F.col("opp.attack_strength_5gw").alias("opponent_attack"),
        F.col("opp.defense_weakness_5gw").alias("opponent_defense_weakness"),
        F.col("opp.clean_sheet_rate_5gw").alias("opponent_clean_sheet_rate"),
        C.venue_switch(venue, "opp.away_attack_3gw", "opp.home_attack_3gw").alias("opponent_venue_attack"),
        C.venue_switch(venue, "opp.away_defense_3gw", "opp.home_defense_3gw").alias("opponent_venue_defense"),
        C.venue_switch(venue, "opp.away_cs_rate_3gw", "opp.home_cs_rate_3gw").alias("opponent_venue_cs_rate"),
        F.col("own.clean_sheet_rate_5gw").alias("team_cs_rate"),
        S.lagged_pick_score(x).alias("pick_score"),
        C.ratio_or_null("pr.season_points_before", "pr.games_played_before").alias("points_per_game_before"),
    )
    return out.where(F.col("gameweek") >= F.lit(first_gameweek))
