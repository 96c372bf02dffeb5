"""Model schemas: column names in order, and the types the marts promise."""

import pytest

from pitchlens.plans.league_views import league_inputs
from pitchlens.plans.marts import BACKTEST_OUTPUT, PLAYER_PICKS_OUTPUT
from pitchlens.plans.models import LeagueModels
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def models(spark):
    return LeagueModels(league_inputs(spark, SF_SMALL))


EXPECTED_COLUMNS = {
    "stg_fixtures": ["fixture_id", "gameweek", "finished", "kickoff_time", "home_team_id", "home_goals",
                     "home_fdr", "away_team_id", "away_goals", "away_fdr", "result"],
    "stg_matches": ["match_id", "matchday", "kickoff_time", "status", "home_team_name", "home_team_fd_id",
                    "home_goals", "home_goals_ht", "away_team_name", "away_team_fd_id", "away_goals",
                    "away_goals_ht", "result"],
    "stg_teams": ["team_id", "team_name", "short_name", "strength", "strength_overall_home",
                  "strength_overall_away", "strength_attack_home", "strength_attack_away",
                  "strength_defence_home", "strength_defence_away", "football_data_name"],
    "team_performance": ["team_id", "gameweek", "goals_for", "goals_against", "venue", "match_points",
                         "form_5gw", "attack_strength_5gw", "defense_weakness_5gw", "clean_sheet_rate_5gw",
                         "season_points", "season_goals_for", "season_goals_against", "home_attack_3gw",
                         "home_defense_3gw", "home_cs_rate_3gw", "away_attack_3gw", "away_defense_3gw",
                         "away_cs_rate_3gw", "fixture_id", "kickoff_time"],
    "player_rolling_lagged": ["player_id", "player_name", "position", "team_id", "gameweek", "opponent_team_id",
                              "was_home", "total_points", "minutes", "price", "selected_by", "form_3gw",
                              "form_5gw", "xgi_rolling_3gw", "xgc_rolling_3gw", "yellow_rolling_5gw",
                              "red_rolling_5gw", "bonus_rolling_5gw", "ict_rolling_3gw", "defcon_rolling_3gw",
                              "season_points_before", "games_played_before", "fixture_id", "kickoff_time"],
    "fixture_ticker": ["team_id", "team_name", "short_name", "gameweek", "fixture_order", "opponent_name",
                       "venue", "fdr", "opponent_form", "opponent_attack", "opponent_defense_weakness",
                       "avg_fdr_next_3", "avg_fdr_next_5", "difficulty_label"],
    "player_picks": PLAYER_PICKS_OUTPUT,
    "backtest_picks": BACKTEST_OUTPUT,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_COLUMNS))
def test_model_columns(models, name):
    assert models.model(name).columns == EXPECTED_COLUMNS[name]


def test_player_picks_types(models):
    types = dict(models.player_picks.dtypes)
    assert len(PLAYER_PICKS_OUTPUT) == 49
    assert types["player_id"] == "bigint" and types["pick_score"] == "double"
    assert types["is_differential"] == "boolean" and types["cost_per_point"] == "double"
    assert types["next_fdr"] == "bigint" and types["avg_fdr_next_3"] == "double"
    assert types["net_transfers"] == "bigint" and types["price"] == "double"


def test_window_types(models):
    tp = dict(models.team_performance.dtypes)
    assert tp["season_points"] == "bigint" and tp["match_points"] == "int"
    assert all(tp[c] == "double" for c in ("form_5gw", "clean_sheet_rate_5gw", "home_cs_rate_3gw"))
    pr = dict(models.player_rolling_lagged.dtypes)
    assert pr["games_played_before"] == "bigint" and pr["red_rolling_5gw"] == "bigint"
    fd = dict(models.fixture_difficulty.dtypes)
    assert fd["fixture_order"] == "bigint"
