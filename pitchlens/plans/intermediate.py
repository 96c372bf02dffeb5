"""Rolling team and player form, upcoming fixture difficulty.

Live and lagged (backtest) forms of a model are one function with a ``lag``
argument: lag=1 shifts every frame one row back, so a row only sees matches
played before it.

Ordering inside a team or player is (gameweek, kickoff_time, fixture_id): the
gameweek alone is not unique when a team plays twice in one gameweek, and
frames over a non-total order are not deterministic.  The two tie-break
columns are appended to the outputs that are keyed by match.

``season`` is the list of columns that tell seasons (and competitions) apart.
It leads every window key and every lookup: a team or player starts anew each
season, gameweeks may restart at 1, and a key's rows are bounded by a season's
matches, so plain windows are the right plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlens.functions import columns as C
from pitchlens.operators.latest import latest_values
from pitchlens.operators.rolling import (
    Agg,
    ahead,
    cumulative,
    first_n_with_ahead,
    rolling,
    rolling_by_subgroup,
    sequence_number,
    trailing,
)
from pitchlens.operators.sides import two_sided

MATCH_ORDER = ["gameweek", "kickoff_time", "fixture_id"]
TEAM_KEYS = ["team_id"]
PLAYER_KEYS = ["player_id"]

def team_match_rows(stg_fixtures: DataFrame, finished: bool, season: Sequence[str] = ()) -> DataFrame:
    """U1 + P17 + P19: one row per team and (un)finished fixture."""
    fx = stg_fixtures.where(F.col("finished") == F.lit(finished))
    home = {
        "team_id": "home_team_id", "opponent_id": "away_team_id", "gameweek": "gameweek",
        "goals_for": "home_goals", "goals_against": "away_goals", "fdr": "home_fdr",
        "result": "result", "match_points": C.result_points("result", "home_win"),
        "kickoff_time": "kickoff_time", "fixture_id": "fixture_id",
    }
    away = {
        "team_id": "away_team_id", "opponent_id": "home_team_id", "gameweek": "gameweek",
        "goals_for": "away_goals", "goals_against": "home_goals", "fdr": "away_fdr",
        "result": "result", "match_points": C.result_points("result", "away_win"),
        "kickoff_time": "kickoff_time", "fixture_id": "fixture_id",
    }
    return two_sided(fx, home, away, tag_col="venue", keep=season)


def same(left: str, right: str, season: Sequence[str], **columns: str) -> Column:
    """Join condition: equal season columns, and left column = right column for each pair."""
    pairs = [*((c, c) for c in season), *columns.items()]
    return reduce(and_, (F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in pairs))


TEAM_OUTPUT = [
    "team_id", "gameweek", "goals_for", "goals_against", "venue", "match_points",
    "form_5gw", "attack_strength_5gw", "defense_weakness_5gw", "clean_sheet_rate_5gw",
    "season_points", "season_goals_for", "season_goals_against",
    "home_attack_3gw", "home_defense_3gw", "home_cs_rate_3gw",
    "away_attack_3gw", "away_defense_3gw", "away_cs_rate_3gw",
    "fixture_id", "kickoff_time",
]


def team_performance(stg_fixtures: DataFrame, lag: int = 0, season: Sequence[str] = ()) -> DataFrame:
    """M6 (lag 0) / M7 (lag 1): rolling team form from finished fixtures.

    Blended columns use the last 5 matches and the season so far; venue
    columns the last 3 matches at that venue, attached to rows at that venue
    only (W7: a window over (team, venue) instead of a self-join).  One
    shuffle on team_id serves both window groups.
    """
    keys = [*season, *TEAM_KEYS]
    rows = team_match_rows(stg_fixtures, True, season).withColumn(
        "_clean", C.indicator(F.col("goals_against") == F.lit(0)))
    five, three, so_far = trailing(5, lag), trailing(3, lag), cumulative(lag)
    # blended window first: its shuffle on team_id also serves (team_id, venue)
    rows = rolling(rows, keys, MATCH_ORDER, {
        "form_5gw": Agg("avg", "match_points", five),
        "attack_strength_5gw": Agg("avg", "goals_for", five),
        "defense_weakness_5gw": Agg("avg", "goals_against", five),
        "clean_sheet_rate_5gw": Agg("avg", "_clean", five),
        "season_points": Agg("sum", "match_points", so_far),
        "season_goals_for": Agg("sum", "goals_for", so_far),
        "season_goals_against": Agg("sum", "goals_against", so_far),
    })
    rows = rolling_by_subgroup(rows, keys, "venue", MATCH_ORDER, {
        f"{venue}_{name}": (venue, Agg("avg", src, three))
        for venue in ("home", "away")
        for name, src in (("attack_3gw", "goals_for"), ("defense_3gw", "goals_against"),
                          ("cs_rate_3gw", "_clean"))
    })
    return rows.select(*season, *TEAM_OUTPUT)


HOME_MEANS = ["home_attack_3gw", "home_defense_3gw", "home_cs_rate_3gw"]


def home_means(rows: DataFrame, lag: int = 0, season: Sequence[str] = ()) -> DataFrame:
    """trailing means over a team's home matches alone, a row per home match."""
    home = rows.where(F.col("venue") == F.lit("home")).withColumn("_clean", C.indicator(F.col("goals_against") == F.lit(0)))
    means = zip(HOME_MEANS, ("goals_for", "goals_against", "_clean"), strict=True)
    return rolling(home, [*season, *TEAM_KEYS], MATCH_ORDER, {name: Agg("avg", src, trailing(3, lag)) for name, src in means})


PLAYER_CONTEXT = ["player_id", "player_name", "position", "team_id", "gameweek",
                  "opponent_team_id", "was_home", "total_points", "minutes", "price", "selected_by"]


def player_rolling(stg_player_gameweeks: DataFrame, stg_players: DataFrame, lag: int = 0,
                   season: Sequence[str] = ()) -> DataFrame:
    """M8 (lag 0) / M9 (lag 1): rolling player form per appearance.

    The inner join keeps appearances of players in the current snapshot and
    takes position and team from it.  The join's hash partitioning on
    player_id is reused by the window, so there is no second shuffle.
    """
    keys = [*season, *PLAYER_KEYS]
    pg = stg_player_gameweeks.select(
        *keys, "gameweek", "opponent_team_id", "was_home", "total_points", "minutes",
        "xgi", "xgc", "ict_index", "price", "selected_by", "defensive_contribution",
        "yellow_cards", "red_cards", "bonus", "kickoff_time", "fixture_id")
    pl = stg_players.select(*keys, "position", "team_id", "player_name")
    rows = pg.join(pl, keys, "inner")
    three, five, so_far = trailing(3, lag), trailing(5, lag), cumulative(lag)
    suffix = "_before" if lag else ""
    aggs = {
        "form_3gw": Agg("avg", "total_points", three),
        "form_5gw": Agg("avg", "total_points", five),
        "xgi_rolling_3gw": Agg("avg", "xgi", three),
        "xgc_rolling_3gw": Agg("avg", "xgc", three),
        "yellow_rolling_5gw": Agg("avg", "yellow_cards", five),
        "red_rolling_5gw": Agg("sum", "red_cards", five),
        "bonus_rolling_5gw": Agg("avg", "bonus", five),
        "ict_rolling_3gw": Agg("avg", "ict_index", three),
        "defcon_rolling_3gw": Agg("avg", "defensive_contribution", three),
        f"season_points{suffix}": Agg("sum", "total_points", so_far),
        f"games_played{suffix}": Agg("count", None, so_far),
    }
    rows = rolling(rows, keys, MATCH_ORDER, aggs)
    return rows.select(*season, *PLAYER_CONTEXT, *aggs, "fixture_id", "kickoff_time")


TEAM_STAT_COLUMNS = {
    "form_5gw": "form_5gw",
    "attack_strength_5gw": "attack_strength_5gw",
    "defense_weakness_5gw": "defense_weakness_5gw",
    "clean_sheet_rate_5gw": "clean_sheet_rate_5gw",
    "home_attack_3gw": ("home_attack_3gw", "home_attack_3gw"),
    "home_defense_3gw": ("home_defense_3gw", "home_attack_3gw"),
    "home_cs_rate_3gw": ("home_cs_rate_3gw", "home_attack_3gw"),
    "away_attack_3gw": ("away_attack_3gw", "away_attack_3gw"),
    "away_defense_3gw": ("away_defense_3gw", "away_attack_3gw"),
    "away_cs_rate_3gw": ("away_cs_rate_3gw", "away_attack_3gw"),
}


def latest_team_stats(team_perf: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """D1 + D2 in one aggregation: each team's latest blended stats, and its
    latest home / away stats among the matches where they exist."""
    return latest_values(team_perf, [*season, *TEAM_KEYS], MATCH_ORDER, TEAM_STAT_COLUMNS)


FIXTURE_DIFFICULTY_OUTPUT = [
    "team_id", "gameweek", "opponent_id", "fdr", "venue", "opponent_name",
    "opponent_form", "opponent_attack", "opponent_defense_weakness", "opponent_clean_sheet_rate",
    "opponent_venue_attack", "opponent_venue_defense", "opponent_venue_cs_rate",
    "fixture_order", "avg_fdr_next_3", "avg_fdr_next_5", "fixture_id", "kickoff_time",
]


def fixture_difficulty(stg_fixtures: DataFrame, team_stats: DataFrame, stg_teams: DataFrame,
                       horizon: int | None = None, season: Sequence[str] = ()) -> DataFrame:
    """Each team's upcoming fixtures with opponent context.

    Sequence number and look-ahead means share one window (same keys, same
    order) and run before the opponent lookups, which join one row per team.
    ``horizon``: keep only the next ``horizon`` fixtures per team (the
    ticker's 8, the picks' 1).  Then rows are cut at horizon + 4 before the
    shuffle (group limit), the look-ahead means stay exact.
    """
    keys = [*season, *TEAM_KEYS]
    upcoming = team_match_rows(stg_fixtures, False, season).select(
        *keys, "gameweek", "opponent_id", "fdr", "venue", "kickoff_time", "fixture_id")
    ahead_means = {
        "avg_fdr_next_3": Agg("avg", "fdr", ahead(3)),
        "avg_fdr_next_5": Agg("avg", "fdr", ahead(5)),
    }
    if horizon is not None:
        upcoming = first_n_with_ahead(upcoming, keys, MATCH_ORDER, horizon, "fixture_order", ahead_means)
    else:
        upcoming = sequence_number(upcoming, keys, MATCH_ORDER, "fixture_order", ahead_means)
    u, o, t = upcoming.alias("u"), team_stats.alias("o"), stg_teams.alias("t")

    def switch(away_stat: str, home_stat: str):
        # the opponent of a home side plays away, and vice versa
        return C.venue_switch("u.venue", f"o.{away_stat}", f"o.{home_stat}")

    joined = (u.join(t, same("u", "t", season, opponent_id="team_id"), "left")
               .join(o, same("u", "o", season, opponent_id="team_id"), "left"))
    return joined.select(
        *[F.col(f"u.{c}").alias(c) for c in season], "u.team_id", "u.gameweek", "u.opponent_id", "u.fdr", "u.venue",
        F.col("t.team_name").alias("opponent_name"),
        F.col("o.form_5gw").alias("opponent_form"),
        F.col("o.attack_strength_5gw").alias("opponent_attack"),
        F.col("o.defense_weakness_5gw").alias("opponent_defense_weakness"),
        F.col("o.clean_sheet_rate_5gw").alias("opponent_clean_sheet_rate"),
        switch("away_attack_3gw", "home_attack_3gw").alias("opponent_venue_attack"),
        switch("away_defense_3gw", "home_defense_3gw").alias("opponent_venue_defense"),
        switch("away_cs_rate_3gw", "home_cs_rate_3gw").alias("opponent_venue_cs_rate"),
        "u.fixture_order", "u.avg_fdr_next_3", "u.avg_fdr_next_5", "u.fixture_id", "u.kickoff_time",
    )
