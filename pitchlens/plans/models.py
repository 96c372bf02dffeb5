"""The model graph: raw league tables -> staging -> intermediate -> marts.

``LeagueModels`` builds each model once, lazily, from its inputs.  Staging and
intermediate models are views.  Two small relations are read by several models
with different columns, which Spark would compute anew for each: the latest stats
of every team, and every team's stats by gameweek.  They are *stored*: written
once to the shared folder when first used and read back, which also cuts the
lineage there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame

from pitchlens.plans import intermediate as I
from pitchlens.plans import marts as M
from pitchlens.plans import staging as S
from pitchlens.plans.league_views import LeagueInputs
from pitchlens.sources.bucketed import stored_by_key
from pitchlens.sources.tables import stored_copy


class LeagueModels:
    """``season``: the input columns that tell seasons (and competitions) apart;
    none for inputs of one season.  They lead every window key, every lookup and
    every output.  ``buckets``: store the players and their appearances in so many
    buckets by player when first used; the player models then read them without a
    shuffle."""

    def __init__(self, raw: LeagueInputs, on_fixture: bool = False, season: Sequence[str] = (), buckets: int | None = None):
        self.raw = raw
        self.on_fixture = on_fixture
        self.season = tuple(season)
        self.buckets = buckets

    # staging (views) ---------------------------------------------------
    @cached_property
    def stg_players(self) -> DataFrame:
        return S.stg_players(self.raw.players, self.season)

    @cached_property
    def stg_teams(self) -> DataFrame:
        return S.stg_teams(self.raw.teams, self.raw.team_mapping, self.season)

    @cached_property
    def stg_fixtures(self) -> DataFrame:
        return S.stg_fixtures(self.raw.fixtures, self.season)

    @cached_property
    def stg_matches(self) -> DataFrame:
        return S.stg_matches(self.raw.pl_matches)

    @cached_property
    def stg_player_gameweeks(self) -> DataFrame:
        return S.stg_player_gameweeks(self.raw.player_gameweeks, self.season)

    # intermediate (views) ----------------------------------------------
    @cached_property
    def team_performance(self) -> DataFrame:
        return I.team_performance(self.stg_fixtures, 0, self.season)

    @cached_property
    def team_performance_lagged(self) -> DataFrame:
        return I.team_performance(self.stg_fixtures, 1, self.season)

    @cached_property
    def player_rolling(self) -> DataFrame:
        return I.player_rolling(self.appearances, self.players, 0, self.season)

    @cached_property
    def player_rolling_lagged(self) -> DataFrame:
        return I.player_rolling(self.appearances, self.players, 1, self.season)

    @cached_property
    def fixture_difficulty(self) -> DataFrame:
        return I.fixture_difficulty(self.stg_fixtures, self.latest_team_stats, self.stg_teams, season=self.season)

    def upcoming_head(self, horizon: int) -> DataFrame:
        """fixture_difficulty cut to the next ``horizon`` fixtures per team."""
        return I.fixture_difficulty(self.stg_fixtures, self.latest_team_stats, self.stg_teams, horizon, self.season)

    # by player: stored with ``buckets``, else the views ------------------
    def _by_player(self, df: DataFrame, tag: str, order: Sequence[str]) -> DataFrame:
        return stored_by_key(df, tag, [*self.season, *I.PLAYER_KEYS], order, self.buckets) if self.buckets else df

    @cached_property
    def appearances(self) -> DataFrame:
        return self._by_player(self.stg_player_gameweeks, "appearances", I.MATCH_ORDER)

    @cached_property
    def players(self) -> DataFrame:
        return self._by_player(self.stg_players, "players", ())

    # stored: read more than once ----------------------------------------
    @cached_property
    def latest_team_stats(self) -> DataFrame:
        return stored_copy(I.latest_team_stats(self.team_performance, self.season), "latest-team-stats")

    @cached_property
    def team_stats_by_gameweek(self) -> DataFrame:
        return stored_copy(M.team_stats_by_gameweek(self.team_performance_lagged, self.season), "team-stats-by-gameweek")

    # marts (full) ------------------------------------------------------
    @cached_property
    def player_picks(self) -> DataFrame:
        return M.player_picks(self.stg_players, self.stg_teams, self.upcoming_head(1), self.latest_team_stats, self.season)

    @cached_property
    def fixture_ticker(self) -> DataFrame:
        return M.fixture_ticker(self.upcoming_head(M.TICKER_FIXTURES), self.stg_teams, season=self.season)

    @cached_property
    def backtest_picks(self) -> DataFrame:
        return M.backtest_picks(self.player_rolling_lagged, self.stg_fixtures, self.team_stats_by_gameweek,
                                on_fixture=self.on_fixture, season=self.season)

    @cached_property
    def weekly_top_picks(self) -> DataFrame:
        return M.weekly_top_picks(self.player_picks)

    STAGING = ("stg_players", "stg_teams", "stg_fixtures", "stg_matches", "stg_player_gameweeks")
    INTERMEDIATE = ("team_performance", "team_performance_lagged", "player_rolling",
                    "player_rolling_lagged", "fixture_difficulty")
    MARTS = ("player_picks", "fixture_ticker", "backtest_picks")

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)
