"""Land the two league feeds as the raw tables the staging models read.

Declared schemas (never inferred) for the fantasy feed's documents --
the bootstrap document (``elements``, ``teams``, ``events``), the fixtures
array and the per-player history documents -- and for the match feed's
``matches``, ``standings`` and ``scorers`` documents.  The declared fields are those
the models read; every record also keeps its whole source text in ``_record``, so
no other field is lost.  JSON keys keep their names, top-level columns become
snake_case (S7), and the match feed's nested team / score objects stay JSON
text (S5), which the staging model parses.

``league_inputs_from_feeds`` lands all feeds as one load: every document is scanned
and parsed once (the bootstrap's three arrays in one pass), the tables' grains are
checked (S9), and all tables become visible together (S6); the models read the
published tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.plans.league_views import LeagueInputs
from pitchlens.functions.columns import parsed_json
from pitchlens.sources.landing import nested_as_json, normalize_columns, tagged_records, typed_records
from pitchlens.sources.large_json import read_records
from pitchlens.sources.published import TAG, Load, publish
from pitchlens.sources.tables import TEAM_MAPPING_SCHEMA, load_seed

L, S, B, TS = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampType()


def _struct(fields: dict) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# The feed fields read by the models, with their JSON types.
PLAYER_FIELDS = {
    "id": L, "web_name": S, "first_name": S, "second_name": S, "element_type": L, "team": L, "now_cost": L,
    "total_points": L, "minutes": L, "goals_scored": L, "assists": L, "clean_sheets": L,
    "defensive_contribution": L, "goals_conceded": L, "own_goals": L, "penalties_saved": L,
    "penalties_missed": L, "yellow_cards": L, "red_cards": L, "saves": L, "bonus": L, "bps": L,
    "influence": S, "creativity": S, "threat": S, "ict_index": S, "expected_goals": S, "expected_assists": S,
    "expected_goal_involvements": S, "expected_goals_conceded": S, "form": S, "points_per_game": S,
    "selected_by_percent": S, "ep_next": S, "value_form": S, "value_season": S, "transfers_in_event": L,
    "transfers_out_event": L, "chance_of_playing_next_round": L, "status": S, "news": S,
}
TEAM_FIELDS = {
    "id": L, "name": S, "short_name": S, "strength": L, "strength_overall_home": L, "strength_overall_away": L,
    "strength_attack_home": L, "strength_attack_away": L, "strength_defence_home": L, "strength_defence_away": L,
}
GAMEWEEK_FIELDS = {"id": L, "name": S, "deadline_time": TS, "finished": B, "is_current": B, "is_next": B}
FIXTURE_FIELDS = {
    "id": L, "event": L, "finished": B, "kickoff_time": TS, "team_h": L, "team_a": L,
    "team_h_score": L, "team_a_score": L, "team_h_difficulty": L, "team_a_difficulty": L,
}
HISTORY_FIELDS = {
    "element": L, "round": L, "fixture": L, "opponent_team": L, "was_home": B, "kickoff_time": TS,
    "team_h_score": L, "team_a_score": L, "total_points": L, "minutes": L, "starts": L, "goals_scored": L,
    "assists": L, "expected_goals": S, "expected_assists": S, "expected_goal_involvements": S,
    "clean_sheets": L, "defensive_contribution": L, "goals_conceded": L, "expected_goals_conceded": S,
    "bonus": L, "bps": L, "influence": S, "creativity": S, "threat": S, "ict_index": S, "value": L,
    "selected": L, "transfers_in": L, "transfers_out": L, "transfers_balance": L, "yellow_cards": L,
    "red_cards": L, "penalties_saved": L, "penalties_missed": L, "own_goals": L, "saves": L,
}
_SIDE = _struct({"home": L, "away": L})
_TEAM_REF = _struct({"id": L, "name": S})
MATCH_FIELDS = {
    "id": L, "matchday": L, "utcDate": TS, "status": S, "homeTeam": _TEAM_REF, "awayTeam": _TEAM_REF,
    "score": _struct({"winner": S, "fullTime": _SIDE, "halfTime": _SIDE}),
}
STANDING_FIELDS = {
    "position": L, "team": _TEAM_REF, "playedGames": L, "won": L, "draw": L, "lost": L, "points": L,
    "goalsFor": L, "goalsAgainst": L, "goalDifference": L,
}
SCORER_FIELDS = {
    "player": _TEAM_REF, "team": _TEAM_REF, "playedMatches": L, "goals": L, "assists": L, "penalties": L,
}
RECORD = "_record"


def whole_records(docs: DataFrame, field: str, fields: dict, doc_col: str = "value") -> DataFrame:
    """S1 over document texts: the declared fields of each record of array ``field``
    (of the top-level array when empty), and its whole text in ``_record``.

    The records are taken as variants, so nothing undeclared is dropped; a document
    or field that doesn't parse fails the load.
    """
    whole = F.parse_json(doc_col)
    array = F.variant_get(whole, f"$.{field}" if field else "$", "array<variant>")
    kept = [c for c in docs.columns if c != doc_col]
    rows = docs.select(*kept, F.explode(array).alias("v")).select(*kept, F.to_json("v").alias(RECORD))
    parsed = rows.withColumn("r", parsed_json(RECORD, _struct(fields)))
    return parsed.select(*kept, "r.*", RECORD)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: its text and name."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"))


BOOTSTRAP = {"players": ("elements", _struct(PLAYER_FIELDS)), "teams": ("teams", _struct(TEAM_FIELDS)),
             "gameweeks": ("events", _struct(GAMEWEEK_FIELDS))}
# unique keys of the raw tables; the seed's is declared by the feeds' owner, the others are the feeds' ids
GRAINS = {"team_mapping": ["fpl_team_id"], "players": ["id"], "teams": ["id"], "gameweeks": ["id"], "fixtures": ["id"],
          "player_gameweeks": ["element", "fixture"], "pl_matches": ["id"]}


def large_records(spark: SparkSession, path: str, arrays: Mapping[str, tuple[str, T.StructType]]) -> DataFrame:
    """``tagged_records`` of files too large for one task each: read in pieces; ``_record`` is a
    record's text as it stands in the file."""
    rows = read_records(spark, path, {table: field for table, (field, _) in arrays.items()})
    return typed_records(rows.select(TAG, F.col("text").alias(RECORD)), {table: schema for table, (_, schema) in arrays.items()}, RECORD)


def bootstrap_records(spark: SparkSession, path: str, large: bool = False) -> DataFrame:
    """Players, teams and gameweeks of bootstrap documents, in one pass (tagged rows)."""
    if large:
        return large_records(spark, path, BOOTSTRAP)
    return tagged_records(read_texts(spark, path).select("value"), BOOTSTRAP, record=RECORD)


def land_bootstrap(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Players, teams and gameweeks as tables of their own."""
    rows = bootstrap_records(spark, path)
    return {t: rows.where(F.col(TAG) == t).select(f"{t}.*") for t in BOOTSTRAP}


def _array(spark: SparkSession, path: str, field: str, fields: dict, large: bool) -> DataFrame:
    if large:
        return large_records(spark, path, {"r": (field, _struct(fields))}).select("r.*")
    return whole_records(read_texts(spark, path).select("value"), field, fields)


def land_fixtures(spark: SparkSession, path: str, large: bool = False) -> DataFrame:
    """The fixtures endpoint is a top-level array."""
    return _array(spark, path, "", FIXTURE_FIELDS, large)


def land_histories(spark: SparkSession, path: str, players: DataFrame) -> DataFrame:
    """S3: per-player history documents (files ``element-<id>.json``) of active
    players (minutes, missing -> 0, > 0).  A file of another name fails the load."""
    docs = read_texts(spark, path)
    number = F.regexp_extract("file", r"^element-([0-9]+)\.json$", 1)
    docs = docs.select("value", F.when(number != "", number.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("not a history document: "), F.col("file")))).alias("player"))
    active = players.where(F.coalesce(F.col("minutes"), F.lit(0)) > F.lit(0)).select(F.col("id").alias("player"))
    return whole_records(docs.join(active, "player", "left_semi"), "history", HISTORY_FIELDS).drop("player")


def _match_feed(rows: DataFrame) -> DataFrame:
    """S7 + S5: snake_case columns, nested objects as JSON text."""
    return nested_as_json(normalize_columns(rows), depth=0)


def land_matches(spark: SparkSession, path: str, large: bool = False) -> DataFrame:
    """Match rows."""
    return _match_feed(_array(spark, path, "matches", MATCH_FIELDS, large))


def land_standings(spark: SparkSession, path: str) -> DataFrame:
    """Table rows of every standing, with the standing's type as ``standing_type``."""
    docs = read_texts(spark, path).select("value")
    outer = whole_records(docs, "standings", {"type": S}).select(F.col("type").alias("standing_type"), F.col(RECORD).alias("value"))
    return _match_feed(whole_records(outer, "table", STANDING_FIELDS))


def land_scorers(spark: SparkSession, path: str) -> DataFrame:
    """Top scorers."""
    return _match_feed(whole_records(read_texts(spark, path).select("value"), "scorers", SCORER_FIELDS))


def store_raw_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Publish raw tables together and return readers of them.

    A document that doesn't parse, or a grain that is violated, leaves the last load as it was.
    """
    new = publish(spark, root, tables, {t: keys for t, keys in GRAINS.items() if t in tables})
    return {name: new.read(spark, name) for name in tables}


def league_inputs_from_feeds(spark: SparkSession, bootstrap: str, fixtures: str, histories: str,
                             matches: str, team_mapping_csv: str, raw_root: str, standings: str | None = None,
                             scorers: str | None = None, large: bool = False) -> LeagueInputs:
    """Land the feeds as one load of ``raw_root`` and read it as the models' inputs.

    ``standings`` and ``scorers``, where given, are stored as ``pl_standings`` and
    ``pl_scorers`` in the same load; no model reads them.  ``large``: bootstrap, fixtures and
    matches may be files larger than a task should hold.
    """
    load = Load(spark, raw_root)
    boot = load.write_tagged(bootstrap_records(spark, bootstrap, large), GRAINS)
    rest = {
        "team_mapping": load_seed(spark, team_mapping_csv, TEAM_MAPPING_SCHEMA),
        "fixtures": land_fixtures(spark, fixtures, large),
        "player_gameweeks": land_histories(spark, histories, boot["players"]),
        "pl_matches": land_matches(spark, matches, large),
    }
    if standings:
        rest["pl_standings"] = land_standings(spark, standings)
    if scorers:
        rest["pl_scorers"] = land_scorers(spark, scorers)
    for name, df in rest.items():
        load.write(name, df, GRAINS.get(name, ()))
    new = load.commit()
    return LeagueInputs(**{t: new.read(spark, t) for t in (
        "teams", "players", "team_mapping", "fixtures", "player_gameweeks", "pl_matches")})
