"""M1-M5: staging models -- rename, type and clean the raw league tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.functions import columns as C

# Position codes of the fantasy feed.
POSITION_LABELS = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}
# Match-feed statuses kept by the match staging model.
KEPT_MATCH_STATUSES = ["FINISHED", "IN_PLAY", "PAUSED", "TIMED", "SCHEDULED"]
# Availability default (percent) when the feed gives none.
DEFAULT_CHANCE_OF_PLAYING = 100


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0))


def stg_players(players: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """M1: one row per available player (status NULL or 'u' is dropped).

    ``season`` names the columns that tell seasons (and competitions) apart,
    here and in the other models; they come first in every output.
    """
    num = C.text_number
    return players.where(F.col("status") != F.lit("u")).select(
        *season,
        F.col("id").alias("player_id"),
        F.col("web_name").alias("player_name"),
        "first_name",
        "second_name",
        F.col("element_type").alias("position_id"),
        C.code_label("element_type", POSITION_LABELS).alias("position"),
        F.col("team").alias("team_id"),
        C.scaled("now_cost").alias("price"),
        *[_zero(c).alias(c) for c in (
            "total_points", "minutes", "goals_scored", "assists", "clean_sheets",
            "defensive_contribution", "goals_conceded", "own_goals", "penalties_saved",
            "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus")],
        num("influence").alias("influence"),
        num("creativity").alias("creativity"),
        num("threat").alias("threat"),
        num("ict_index").alias("ict_index"),
        _zero("bps").alias("bps"),
        num("expected_goals").alias("xg"),
        num("expected_assists").alias("xa"),
        num("expected_goal_involvements").alias("xgi"),
        num("expected_goals_conceded").alias("xgc"),
        num("selected_by_percent").alias("ownership_pct"),
        _zero("transfers_in_event").alias("transfers_in_gw"),
        _zero("transfers_out_event").alias("transfers_out_gw"),
        num("form").alias("form"),
        num("points_per_game").alias("points_per_game"),
        num("ep_next").alias("expected_points_next"),
        num("value_form").alias("value_form"),
        num("value_season").alias("value_season"),
        F.coalesce(F.col("chance_of_playing_next_round"), F.lit(DEFAULT_CHANCE_OF_PLAYING)).alias("chance_of_playing"),
        "status",
        "news",
    )


def stg_teams(teams: DataFrame, team_mapping: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """M2: teams with strength ratings and their match-feed name (left join)."""
    t, m = teams.alias("t"), team_mapping.alias("m")
    return t.join(m, F.col("t.id") == F.col("m.fpl_team_id"), "left").select(
        *[F.col(f"t.{c}").alias(c) for c in season],
        F.col("t.id").alias("team_id"),
        F.col("t.name").alias("team_name"),
        F.col("t.short_name").alias("short_name"),
        *[F.col(f"t.{c}").alias(c) for c in (
            "strength", "strength_overall_home", "strength_overall_away",
            "strength_attack_home", "strength_attack_away",
            "strength_defence_home", "strength_defence_away")],
        F.col("m.football_data_name").alias("football_data_name"),
    )


def stg_fixtures(fixtures: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """M3: scheduled fixtures (gameweek known) with result label."""
    return fixtures.where(F.col("event").isNotNull()).select(
        *season,
        F.col("id").alias("fixture_id"),
        F.col("event").alias("gameweek"),
        "finished",
        "kickoff_time",
        F.col("team_h").alias("home_team_id"),
        F.col("team_h_score").alias("home_goals"),
        F.col("team_h_difficulty").alias("home_fdr"),
        F.col("team_a").alias("away_team_id"),
        F.col("team_a_score").alias("away_goals"),
        F.col("team_a_difficulty").alias("away_fdr"),
        C.outcome_from_scores("finished", "team_h_score", "team_a_score").alias("result"),
    )


# Every leaf is read as text and cast afterwards, exactly like a JSON path
# extraction followed by CAST: malformed numbers raise in the cast, malformed
# documents in the parser (FAILFAST); nothing malformed turns into NULL.
_TEAM_JSON = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
_SIDES = T.StructType([T.StructField("home", T.StringType()), T.StructField("away", T.StringType())])
_SCORE_JSON = T.StructType([
    T.StructField("winner", T.StringType()),
    T.StructField("fullTime", _SIDES),
    T.StructField("halfTime", _SIDES),
])


def stg_matches(pl_matches: DataFrame) -> DataFrame:
    """M4: match-feed results; JSON columns parsed once each."""
    parsed = pl_matches.where(F.col("status").isin(KEPT_MATCH_STATUSES)).select(
        "id", "matchday", "utc_date", "status",
        C.parsed_json("home_team", _TEAM_JSON).alias("h"),
        C.parsed_json("away_team", _TEAM_JSON).alias("a"),
        C.parsed_json("score", _SCORE_JSON).alias("s"),
    )
    return parsed.select(
        F.col("id").alias("match_id"),
        "matchday",
        F.col("utc_date").alias("kickoff_time"),
        "status",
        F.col("h.name").alias("home_team_name"),
        F.col("h.id").cast("int").alias("home_team_fd_id"),
        F.col("s.fullTime.home").cast("int").alias("home_goals"),
        F.col("s.halfTime.home").cast("int").alias("home_goals_ht"),
        F.col("a.name").alias("away_team_name"),
        F.col("a.id").cast("int").alias("away_team_fd_id"),
        F.col("s.fullTime.away").cast("int").alias("away_goals"),
        F.col("s.halfTime.away").cast("int").alias("away_goals_ht"),
        C.outcome_from_winner("s.winner").alias("result"),
    )


def stg_player_gameweeks(player_gameweeks: DataFrame, season: Sequence[str] = ()) -> DataFrame:
    """M5: one row per player and fixture actually played (minutes > 0)."""
    num = C.text_number
    return player_gameweeks.where(F.col("minutes") > F.lit(0)).select(
        *season,
        F.col("element").alias("player_id"),
        F.col("round").alias("gameweek"),
        F.col("fixture").alias("fixture_id"),
        F.col("opponent_team").alias("opponent_team_id"),
        "was_home",
        "kickoff_time",
        F.col("team_h_score").alias("home_goals"),
        F.col("team_a_score").alias("away_goals"),
        "total_points", "minutes", "starts", "goals_scored", "assists",
        num("expected_goals").alias("xg"),
        num("expected_assists").alias("xa"),
        num("expected_goal_involvements").alias("xgi"),
        "clean_sheets", "defensive_contribution", "goals_conceded",
        num("expected_goals_conceded").alias("xgc"),
        "bonus", "bps",
        num("influence").alias("influence"),
        num("creativity").alias("creativity"),
        num("threat").alias("threat"),
        num("ict_index").alias("ict_index"),
        C.scaled("value").alias("price"),
        F.col("selected").alias("selected_by"),
        "transfers_in", "transfers_out",
        F.col("transfers_balance").alias("net_transfers"),
        "yellow_cards", "red_cards", "penalties_saved", "penalties_missed", "own_goals", "saves",
    )
