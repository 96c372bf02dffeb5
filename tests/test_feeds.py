"""End to end from landed feed documents: JSON files -> raw tables -> models."""

import json
import os

import pytest

from pitchlens.plans.models import LeagueModels
from pitchlens.sources.league_feeds import (
    bootstrap_records, land_bootstrap, land_fixtures, land_histories, land_matches, land_scorers, land_standings, league_inputs_from_feeds, store_raw_tables,
)
from pitchlens.sources.published import TAG
from pitchlens.sources.tables import read_table


def _player(pid, team, pos, form, minutes=900, status="a"):
    return {"id": pid, "web_name": f"P{pid}", "element_type": pos, "team": team, "now_cost": 60 + pid,
            "total_points": 50, "minutes": minutes, "form": form, "points_per_game": "4.0",
            "selected_by_percent": "5.5", "transfers_in_event": 100, "transfers_out_event": 40,
            "chance_of_playing_next_round": None, "status": status, "ict_index": "10.1", "unknown": 1}


def _write(path, obj):
    with open(path, "w") as f:
        json.dump(obj, f)


def test_models_from_landed_feeds(spark, tmp_dir):
    boot = {"elements": [_player(1, 1, 3, "6.0"), _player(2, 2, 2, "3.5"), _player(3, 1, 4, "0.0", minutes=0)],
            "teams": [{"id": 1, "name": "One", "short_name": "ONE", "strength": 4},
                      {"id": 2, "name": "Two", "short_name": "TWO", "strength": 3}],
            "events": [{"id": 1, "name": "Gameweek 1", "finished": True}]}
    fixtures = [
        {"id": 10 + gw, "event": gw, "finished": gw <= 3, "kickoff_time": f"2025-08-{10 + gw}T15:00:00Z",
         "team_h": 1 if gw % 2 else 2, "team_a": 2 if gw % 2 else 1,
         "team_h_score": (gw % 3) if gw <= 3 else None, "team_a_score": 1 if gw <= 3 else None,
         "team_h_difficulty": 3, "team_a_difficulty": 2 + gw % 3}
        for gw in range(1, 7)]
    hist_dir = os.path.join(tmp_dir, "history")
    os.makedirs(hist_dir)
    for pid in (1, 2, 3):
        _write(os.path.join(hist_dir, f"element-{pid}.json"), {"history": [
            {"element": pid, "round": gw, "fixture": 10 + gw, "minutes": 90, "total_points": gw + pid,
             "expected_goal_involvements": "0.25", "was_home": bool(gw % 2), "value": 60}
            for gw in (1, 2, 3)]})
    matches = {"matches": [
        {"id": 5, "matchday": 1, "utcDate": "2025-08-11T15:00:00Z", "status": "FINISHED",
         "homeTeam": {"id": 57, "name": "One FC"}, "awayTeam": {"id": 58, "name": "Two FC"},
         "score": {"winner": "HOME_TEAM", "fullTime": {"home": 2, "away": 1}, "halfTime": {"home": 1, "away": 0}}},
        {"id": 6, "matchday": 4, "utcDate": "2025-09-01T15:00:00Z", "status": "TIMED",
         "homeTeam": {"id": 58, "name": "Two FC"}, "awayTeam": {"id": 57, "name": "One FC"},
         "score": {"winner": None, "fullTime": {"home": None, "away": None}}}]}
    paths = {n: os.path.join(tmp_dir, f"{n}.json") for n in ("bootstrap", "fixtures", "matches")}
    _write(paths["bootstrap"], boot)
    _write(paths["fixtures"], fixtures)
    _write(paths["matches"], matches)
    seed = os.path.join(tmp_dir, "seed.csv")
    with open(seed, "w") as f:
        f.write("fpl_team_id,fpl_name,fpl_short_name,football_data_name,football_data_id\n1,One,ONE,One FC,57\n")

    raw = league_inputs_from_feeds(spark, paths["bootstrap"], paths["fixtures"], hist_dir,
                                   paths["matches"], seed, os.path.join(tmp_dir, "raw"))
    m = LeagueModels(raw)
    # fields that no model reads are kept in the record's text
    assert all(json.loads(r["_record"])["unknown"] == 1 for r in raw.players.collect())
    # history of the inactive player (minutes 0) is not landed
    assert sorted({r.element for r in raw.player_gameweeks.collect()}) == [1, 2]
    matches_rows = {r.match_id: r for r in m.stg_matches.collect()}
    assert matches_rows[5].result == "home_win" and matches_rows[5].home_goals_ht == 1
    assert matches_rows[6].result == "scheduled" and matches_rows[6].home_team_name == "Two FC"
    teams = {r.team_id: r.football_data_name for r in m.stg_teams.collect()}
    assert teams == {1: "One FC", 2: None}
    picks = {r.player_id: r for r in m.player_picks.collect()}
    assert set(picks) == {1, 2}                       # player 3 has no minutes
    assert picks[1].next_gw == 4 and picks[1].pick_score is not None
    assert m.backtest_picks.count() == 0              # gameweeks < 5 only
    assert m.player_rolling_lagged.count() == 6


def test_standings_and_scorers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "standings.json")
    _write(path, {"standings": [
        {"type": kind, "stage": "REGULAR", "table": [
            {"position": k, "team": {"id": k, "name": f"T{k}"}, "playedGames": 3, "points": 9 - k, "form": "W"} for k in (1, 2)]}
        for kind in ("TOTAL", "HOME")]})
    rows = land_standings(spark, path).collect()
    assert sorted((r.standing_type, r.position, r.played_games, r.points) for r in rows) == [
        (kind, k, 3, 9 - k) for kind in ("HOME", "TOTAL") for k in (1, 2)]
    assert all(json.loads(r.team)["name"] == f"T{r.position}" and json.loads(r["_record"])["form"] == "W" for r in rows)
    path = os.path.join(tmp_dir, "scorers.json")
    _write(path, {"scorers": [{"player": {"id": 4, "name": "P"}, "team": {"id": 1}, "goals": 7, "playedMatches": 5}]})
    row = land_scorers(spark, path).collect()[0]
    assert (json.loads(row.player)["name"], row.goals, row.played_matches) == ("P", 7, 5)


def test_a_broken_load_leaves_the_tables(spark, tmp_dir):
    good, bad, root = (os.path.join(tmp_dir, n) for n in ("good.json", "bad.json", "raw"))
    _write(good, {"elements": [{"id": 1}], "teams": [{"id": 2}], "events": []})
    with open(bad, "w") as f:
        f.write('{"elements": [{"id": 9}], "teams": [{"id"')
    store_raw_tables(spark, land_bootstrap(spark, good), root)
    with pytest.raises(Exception):
        store_raw_tables(spark, land_bootstrap(spark, bad), root)
    _write(bad, {"elements": [{"id": 9}], "teams": [{"id": "two"}], "events": []})
    with pytest.raises(Exception):
        store_raw_tables(spark, land_bootstrap(spark, bad), root)
    assert [r.id for r in read_table(spark, f"{root}/players").collect()] == [1]
    _write(good, {"elements": [{"id": 3}, {"id": 4}], "teams": [], "events": []})
    stored = store_raw_tables(spark, land_bootstrap(spark, good), root)
    assert sorted(r.id for r in stored["players"].collect()) == [3, 4] and stored["teams"].count() == 0


def test_a_history_document_of_another_name_raises(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "other-7.json"), {"history": []})
    players = spark.createDataFrame([(7, 90)], "id long, minutes long")
    with pytest.raises(Exception):
        land_histories(spark, tmp_dir, players).collect()


def test_large_files_give_the_same_tables(spark, tmp_dir):
    boot, fixtures, matches = (os.path.join(tmp_dir, f"{n}.json") for n in ("bootstrap", "fixtures", "matches"))
    _write(boot, {"elements": [_player(k, 1, 3, "6.0") | {"news": "}],{" * k} for k in range(40)], "teams": [{"id": 1, "name": "One"}], "events": []})
    _write(fixtures, [{"id": k, "event": k, "finished": True, "kickoff_time": "2025-08-11T15:00:00Z"} for k in range(50)])
    _write(matches, {"count": 2, "matches": [{"id": k, "utcDate": "2025-08-11T15:00:00Z", "homeTeam": {"id": k, "name": "A"}} for k in range(9)]})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        for plain, large in ((land_fixtures(spark, fixtures), land_fixtures(spark, fixtures, large=True)),
                             (land_matches(spark, matches), land_matches(spark, matches, large=True)),
                             *(([bootstrap_records(spark, boot, large).where(f"{TAG} = '{t}'").select(f"{t}.*") for large in (False, True)])
                               for t in ("players", "teams", "gameweeks"))):
            assert plain.schema == large.schema
            a, b = ([{**r.asDict(), "_record": json.loads(r["_record"])} for r in df.collect()] for df in (plain, large))
            assert sorted(a, key=lambda r: r["id"]) == sorted(b, key=lambda r: r["id"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
