"""Builders for hand fixtures: raw league tables with only the columns a test sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

FIXTURE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("event", T.LongType()),
    T.StructField("finished", T.BooleanType()),
    T.StructField("kickoff_time", T.TimestampNTZType()),
    T.StructField("team_h", T.LongType()),
    T.StructField("team_a", T.LongType()),
    T.StructField("team_h_score", T.LongType()),
    T.StructField("team_a_score", T.LongType()),
    T.StructField("team_h_difficulty", T.LongType()),
    T.StructField("team_a_difficulty", T.LongType()),
])


def kickoff(gw: int, hour: int = 15) -> dt.datetime:
    return dt.datetime(2025, 8, 1, hour) + dt.timedelta(days=7 * gw)


def fixture(fid, gw, home, away, hs=None, as_=None, finished=True, hd=3, ad=3, hour=15):
    return (fid, gw, finished, kickoff(gw or 0, hour), home, away, hs, as_, hd, ad)


def fixtures_df(spark, rows):
    return spark.createDataFrame(rows, FIXTURE_SCHEMA)


PLAYER_COLUMNS = {
    "id": T.LongType(), "web_name": T.StringType(), "first_name": T.StringType(),
    "second_name": T.StringType(), "element_type": T.LongType(), "team": T.LongType(),
    "now_cost": T.LongType(), "total_points": T.LongType(), "minutes": T.LongType(),
    "goals_scored": T.LongType(), "assists": T.LongType(), "clean_sheets": T.LongType(),
    "defensive_contribution": T.LongType(), "goals_conceded": T.LongType(), "own_goals": T.LongType(),
    "penalties_saved": T.LongType(), "penalties_missed": T.LongType(), "yellow_cards": T.LongType(),
    "red_cards": T.LongType(), "saves": T.LongType(), "bonus": T.LongType(), "bps": T.LongType(),
    "influence": T.StringType(), "creativity": T.StringType(), "threat": T.StringType(),
    "ict_index": T.StringType(), "expected_goals": T.StringType(), "expected_assists": T.StringType(),
    "expected_goal_involvements": T.StringType(), "expected_goals_conceded": T.StringType(),
    "form": T.StringType(), "points_per_game": T.StringType(), "selected_by_percent": T.StringType(),
    "ep_next": T.StringType(), "value_form": T.StringType(), "value_season": T.StringType(),
    "transfers_in_event": T.LongType(), "transfers_out_event": T.LongType(),
    "chance_of_playing_next_round": T.LongType(), "status": T.StringType(), "news": T.StringType(),
}
PLAYER_SCHEMA = T.StructType([T.StructField(n, t) for n, t in PLAYER_COLUMNS.items()])


def players_df(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r.get(c) for c in PLAYER_COLUMNS) for r in rows], PLAYER_SCHEMA)


PG_COLUMNS = {
    "element": T.LongType(), "round": T.LongType(), "fixture": T.LongType(), "opponent_team": T.LongType(),
    "was_home": T.BooleanType(), "kickoff_time": T.TimestampNTZType(), "team_h_score": T.LongType(),
    "team_a_score": T.LongType(), "total_points": T.LongType(), "minutes": T.LongType(), "starts": T.LongType(),
    "goals_scored": T.LongType(), "assists": T.LongType(), "expected_goals": T.StringType(),
    "expected_assists": T.StringType(), "expected_goal_involvements": T.StringType(),
    "clean_sheets": T.LongType(), "defensive_contribution": T.LongType(), "goals_conceded": T.LongType(),
    "expected_goals_conceded": T.StringType(), "bonus": T.LongType(), "bps": T.LongType(),
    "influence": T.StringType(), "creativity": T.StringType(), "threat": T.StringType(),
    "ict_index": T.StringType(), "value": T.LongType(), "selected": T.LongType(), "transfers_in": T.LongType(),
    "transfers_out": T.LongType(), "transfers_balance": T.LongType(), "yellow_cards": T.LongType(),
    "red_cards": T.LongType(), "penalties_saved": T.LongType(), "penalties_missed": T.LongType(),
    "own_goals": T.LongType(), "saves": T.LongType(),
}
PG_SCHEMA = T.StructType([T.StructField(n, t) for n, t in PG_COLUMNS.items()])


def player_gameweeks_df(spark, rows: list[dict]):
    return spark.createDataFrame([tuple(r.get(c) for c in PG_COLUMNS) for r in rows], PG_SCHEMA)
