"""League input tables derived from the driver's TPC-H-like tables.

The league models read raw fantasy-feed / match-feed tables.  The driver data has none,
so these functions derive tables of the same shape from ``orders``,
``customer``, ``supplier`` and ``lineitem`` (teams = suppliers, players =
customers, fixtures = orders, appearances = line items of a player's orders).
The derivation is fixed and deterministic; ``oracle_sql.py`` states the same
tables as SQL for the DuckDB oracle.  Every table grows with the driver data.

The number of teams is a scalar subquery (one aggregate evaluated once, then
used as a constant), not a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation (shared with the SQL form in oracle_sql.py).
FINISHED_UP_TO_GAMEWEEK = 280      # gameweeks 1..280 are played, the rest upcoming
UNSCHEDULED_MOD, UNSCHEDULED_REM = 97, 13   # fixture id % 97 = 13 -> no gameweek
SEED_SKIP_MOD = 5                  # suppliers with id % 5 = 0 have no mapping row


@dataclass
class DriverTables:
    """Readers of the driver parquet files under ``sf_dir``.  A table's files are listed
    (and a footer read) at its first access; make a new object to see a replaced table."""

    spark: SparkSession
    sf_dir: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        self.__dict__[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.__dict__[name]


def _team_count(t: DriverTables) -> Column:
    return t.supplier.select(F.count(F.lit(1))).scalar()


def _int(c: Column) -> Column:
    return c.cast("bigint")


def _num_text(c: Column, div: int) -> Column:
    """Numeric text, like the feed's decimal strings."""
    return (c.cast("double") / F.lit(float(div))).cast("string")


def fixtures(t: DriverTables, keep: tuple[str, ...] = ()) -> DataFrame:
    """One fixture per order; ``keep`` carries extra order columns along."""
    with_n = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice", *keep, _team_count(t).alias("n"))
    n = F.col("n")
    base = with_n.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        F.floor("o_totalprice").alias("p"),
        (_int(F.floor(F.col("o_orderkey") / (n / F.lit(2)))) + F.lit(1)).alias("gw"),
        (F.col("o_orderkey") % _int(n / F.lit(2))).alias("j"),
        n, *keep,
    )
    a = (F.col("j") + F.col("gw")) % F.col("n")
    b = (F.col("n") - F.lit(1) - F.col("j") + F.col("gw")) % F.col("n")
    even = (F.col("gw") % F.lit(2)) == F.lit(0)
    played = F.col("gw") <= F.lit(FINISHED_UP_TO_GAMEWEEK)
    return base.select(
        "id",
        F.when((F.col("id") % F.lit(UNSCHEDULED_MOD)) == F.lit(UNSCHEDULED_REM), F.lit(None))
        .otherwise(F.col("gw")).alias("event"),
        played.alias("finished"),
        F.col("ts").alias("kickoff_time"),
        F.when(even, a).otherwise(b).alias("team_h"),
        F.when(even, b).otherwise(a).alias("team_a"),
        F.when(played, F.col("p") % F.lit(5)).alias("team_h_score"),
        F.when(played, _int(F.floor(F.col("p") / F.lit(7))) % F.lit(4)).alias("team_a_score"),
        (F.lit(2) + F.col("p") % F.lit(4)).alias("team_h_difficulty"),
        (F.lit(2) + _int(F.floor(F.col("p") / F.lit(11))) % F.lit(4)).alias("team_a_difficulty"),
        *keep,
    )


def teams(t: DriverTables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        k.alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("T"), k.cast("string")).alias("short_name"),
        (F.lit(1) + k % F.lit(5)).alias("strength"),
        (F.lit(1000) + k % F.lit(300)).alias("strength_overall_home"),
        (F.lit(1000) + (k * F.lit(7)) % F.lit(300)).alias("strength_overall_away"),
        (F.lit(1000) + (k * F.lit(3)) % F.lit(250)).alias("strength_attack_home"),
        (F.lit(1000) + (k * F.lit(11)) % F.lit(250)).alias("strength_attack_away"),
        (F.lit(1000) + (k * F.lit(13)) % F.lit(270)).alias("strength_defence_home"),
        (F.lit(1000) + (k * F.lit(17)) % F.lit(270)).alias("strength_defence_away"),
    )


def team_mapping(t: DriverTables) -> DataFrame:
    """Seed-shaped table (int, string, string, string, int); some teams unmapped."""
    k = F.col("s_suppkey")
    return t.supplier.where((k % F.lit(SEED_SKIP_MOD)) != F.lit(0)).select(
        k.cast("int").alias("fpl_team_id"),
        F.col("s_name").alias("fpl_name"),
        F.concat(F.lit("T"), k.cast("string")).alias("fpl_short_name"),
        F.concat(F.lit("Club "), F.col("s_name")).alias("football_data_name"),
        (k + F.lit(50)).cast("int").alias("football_data_id"),
    )


def players(t: DriverTables) -> DataFrame:
    n = _team_count(t)
    k = F.col("c_custkey")

    def m(mod: int, mul: int = 1) -> Column:
        return (k * F.lit(mul)) % F.lit(mod)

    return t.customer.select(
        k.alias("id"),
        F.col("c_name").alias("web_name"),
        F.concat(F.lit("F"), m(37).cast("string")).alias("first_name"),
        F.col("c_mktsegment").alias("second_name"),
        F.when(m(50) == F.lit(49), F.lit(5)).otherwise(m(4) + F.lit(1)).alias("element_type"),
        (k % n).alias("team"),
        (F.lit(40) + m(90)).alias("now_cost"),
        F.when(m(13) == F.lit(4), F.lit(None)).otherwise(m(200)).alias("total_points"),
        (m(11) * F.lit(90)).alias("minutes"),
        F.when(m(19) == F.lit(2), F.lit(None)).otherwise(m(12)).alias("goals_scored"),
        m(9).alias("assists"),
        m(14, 3).alias("clean_sheets"),
        F.when(m(31) == F.lit(6), F.lit(None)).otherwise(m(60, 5)).alias("defensive_contribution"),
        m(30).alias("goals_conceded"),
        m(3).alias("own_goals"),
        m(2).alias("penalties_saved"),
        m(2, 3).alias("penalties_missed"),
        m(8).alias("yellow_cards"),
        F.when(m(7) == F.lit(0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("red_cards"),
        m(40).alias("saves"),
        m(25).alias("bonus"),
        m(400).alias("bps"),
        _num_text(m(900), 10).alias("influence"),
        _num_text(m(700, 3), 10).alias("creativity"),
        F.when(m(23) == F.lit(1), F.lit(None)).otherwise(_num_text(m(800, 7), 10)).alias("threat"),
        _num_text(m(300), 10).alias("ict_index"),
        _num_text(m(150), 10).alias("expected_goals"),
        _num_text(m(120, 7), 10).alias("expected_assists"),
        _num_text(m(250), 10).alias("expected_goal_involvements"),
        F.when(m(11) == F.lit(3), F.lit(None)).otherwise(_num_text(m(200, 3), 10)).alias("expected_goals_conceded"),
        F.when(m(17) == F.lit(3), F.lit(None)).otherwise(_num_text(m(100), 10)).alias("form"),
        _num_text(m(80), 10).alias("points_per_game"),
        _num_text(m(450), 10).alias("selected_by_percent"),
        _num_text(m(90, 7), 10).alias("ep_next"),
        _num_text(m(60), 10).alias("value_form"),
        _num_text(m(300, 11), 10).alias("value_season"),
        m(1000).alias("transfers_in_event"),
        m(1000, 7).alias("transfers_out_event"),
        F.when(m(5) == F.lit(0), F.lit(75)).when(m(5) == F.lit(1), F.lit(25)).cast("bigint")
        .alias("chance_of_playing_next_round"),
        F.when(m(23) == F.lit(5), F.lit("u")).when(m(29) == F.lit(7), F.lit(None))
        .otherwise(F.lit("a")).alias("status"),
        F.when(m(5) == F.lit(1), F.lit("doubt")).alias("news"),
    )


def player_gameweeks(t: DriverTables, per_fixture: bool = False) -> DataFrame:
    """One row per (customer, gameweek) of the customer's orders' line items; with
    ``per_fixture`` one per (customer, order), so that a customer with two orders
    in a gameweek plays twice in it.

    The fixture of an order is derived from the order row itself (carrying
    its customer), so line items join orders once: one shuffle of each side
    on the order key, then a partial aggregation per (customer, gameweek).
    """
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    fx = fixtures(t, keep=("o_custkey",)).where(F.col("event").isNotNull()).select(
        "id", "o_custkey", "event", "kickoff_time", "team_a", "team_h_score", "team_a_score")
    joined = li.join(fx, li.l_orderkey == fx.id)
    keys = [F.col("o_custkey").alias("element"), F.col("event").alias("round")]
    agg = joined.groupBy(*keys, *([F.col("id").alias("own_fixture")] if per_fixture else [])).agg(
        F.min("id").alias("fixture"),
        F.min("kickoff_time").alias("kickoff_time"),
        F.min("team_a").alias("opponent_team"),
        F.min("team_h_score").alias("team_h_score"),
        F.min("team_a_score").alias("team_a_score"),
        _int(F.sum(F.floor("l_quantity"))).alias("q"),
        _int(F.sum("l_linenumber")).alias("s"),
        _int(F.sum(F.floor("l_extendedprice"))).alias("e"),
        F.count(F.lit(1)).alias("c"),
    )
    q, s, e, c = F.col("q"), F.col("s"), F.col("e"), F.col("c")
    return agg.select(
        "element", "round", "fixture", "opponent_team",
        ((s % F.lit(2)) == F.lit(0)).alias("was_home"),
        "kickoff_time", "team_h_score", "team_a_score",
        (q % F.lit(15)).alias("total_points"),
        F.when((s % F.lit(7)) == F.lit(0), F.lit(0)).otherwise(F.lit(90)).cast("bigint").alias("minutes"),
        (c % F.lit(2)).alias("starts"),
        (c % F.lit(3)).alias("goals_scored"),
        (s % F.lit(3)).alias("assists"),
        _num_text(s % F.lit(20), 100).alias("expected_goals"),
        _num_text(s % F.lit(15), 100).alias("expected_assists"),
        _num_text(s % F.lit(30), 100).alias("expected_goal_involvements"),
        (s % F.lit(2)).alias("clean_sheets"),
        (q % F.lit(13)).alias("defensive_contribution"),
        (c % F.lit(4)).alias("goals_conceded"),
        _num_text(q % F.lit(25), 10).alias("expected_goals_conceded"),
        (s % F.lit(4)).alias("bonus"),
        (q % F.lit(40)).alias("bps"),
        _num_text(q % F.lit(50), 2).alias("influence"),
        _num_text(s % F.lit(40), 2).alias("creativity"),
        _num_text(c % F.lit(9), 2).alias("threat"),
        _num_text(q % F.lit(120), 10).alias("ict_index"),
        (F.lit(40) + q % F.lit(90)).alias("value"),
        (e % F.lit(100000)).alias("selected"),
        ((q * F.lit(37)) % F.lit(5000)).alias("transfers_in"),
        ((c * F.lit(101)) % F.lit(3000)).alias("transfers_out"),
        ((q * F.lit(37)) % F.lit(5000) - (c * F.lit(101)) % F.lit(3000)).alias("transfers_balance"),
        F.when((s % F.lit(5)) == F.lit(0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("yellow_cards"),
        F.when((q % F.lit(23)) == F.lit(0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("red_cards"),
        (c % F.lit(2) * F.lit(0)).alias("penalties_saved"),
        F.when((q % F.lit(31)) == F.lit(0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("penalties_missed"),
        F.when((q % F.lit(37)) == F.lit(0), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("own_goals"),
        (c % F.lit(5)).alias("saves"),
    )


def _json_num(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def pl_matches(t: DriverTables, fixtures_df: DataFrame | None = None) -> DataFrame:
    """Match-feed rows with JSON text columns for teams and score."""
    fx = fixtures_df if fixtures_df is not None else fixtures(t)
    h, a = F.col("team_h_score"), F.col("team_a_score")

    def team_json(c: str) -> Column:
        return F.concat(F.lit('{"id":'), F.col(c).cast("string"), F.lit(',"name":"Team '),
                        F.col(c).cast("string"), F.lit('"}'))

    winner = (F.when(h > a, F.lit('"HOME_TEAM"')).when(h < a, F.lit('"AWAY_TEAM"'))
              .when(h == a, F.lit('"DRAW"')).otherwise(F.lit("null")))
    score = F.concat(
        F.lit('{"winner":'), winner,
        F.lit(',"fullTime":{"home":'), _json_num(h), F.lit(',"away":'), _json_num(a),
        F.lit('},"halfTime":{"home":'), _json_num(_int(F.floor(h / F.lit(2)))),
        F.lit(',"away":'), _json_num(_int(F.floor(a / F.lit(2)))), F.lit("}}"),
    )
    return fx.select(
        F.col("id"),
        F.col("event").alias("matchday"),
        F.col("kickoff_time").alias("utc_date"),
        F.when(F.col("finished"), F.lit("FINISHED"))
        .when((F.col("id") % F.lit(19)) == F.lit(0), F.lit("POSTPONED"))
        .otherwise(F.lit("TIMED")).alias("status"),
        team_json("team_h").alias("home_team"),
        team_json("team_a").alias("away_team"),
        score.alias("score"),
    )


class LeagueInputs:
    """The raw league tables the staging models read.

    Each table is a DataFrame or a zero-argument function building one; a
    function runs on first access, so a query builds only the inputs it uses.
    """

    TABLES = ("fixtures", "teams", "team_mapping", "players", "player_gameweeks", "pl_matches")

    def __init__(self, **tables):
        unknown = set(tables) - set(self.TABLES)
        if unknown:
            raise TypeError(f"unknown input tables {sorted(unknown)}")
        self._src = tables
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.TABLES:
            raise AttributeError(name)
        if name not in self._built:
            src = self._src[name]
            self._built[name] = src() if callable(src) else src
        return self._built[name]


def driver_tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def league_inputs(spark: SparkSession, sf_dir: str) -> LeagueInputs:
    t = driver_tables(spark, sf_dir)
    return LeagueInputs(
        fixtures=lambda: fixtures(t),
        teams=lambda: teams(t),
        team_mapping=lambda: team_mapping(t),
        players=lambda: players(t),
        player_gameweeks=lambda: player_gameweeks(t),
        pl_matches=lambda: pl_matches(t),
    )


# Fixed value of the two-season form: gameweeks after this one are gameweek 1, 2, ...
# of the second season.
FIRST_SEASON_GAMEWEEKS = 150


def _in_seasons(df: DataFrame, gameweek: str) -> DataFrame:
    g, n = F.col(gameweek), F.lit(FIRST_SEASON_GAMEWEEKS)
    return df.select(F.when(g > n, F.lit(2)).otherwise(F.lit(1)).alias("season"),
                     *[F.when(g > n, g - n).otherwise(g).alias(c) if c == gameweek else F.col(c) for c in df.columns])


def _each_season(df: DataFrame) -> DataFrame:
    return df.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("season"), "*")


def two_season_inputs(spark: SparkSession, sf_dir: str) -> LeagueInputs:
    """The same tables as two seasons whose gameweeks both count from 1 (column
    ``season``); teams and players take part in both."""
    t = driver_tables(spark, sf_dir)
    return LeagueInputs(
        fixtures=lambda: _in_seasons(fixtures(t), "event"),
        teams=lambda: _each_season(teams(t)),
        team_mapping=lambda: team_mapping(t),
        players=lambda: _each_season(players(t)),
        player_gameweeks=lambda: _in_seasons(player_gameweeks(t), "round"),
    )


def appearance_inputs(spark: SparkSession, sf_dir: str) -> LeagueInputs:
    """``league_inputs`` with one appearance per fixture (double gameweeks)."""
    t = driver_tables(spark, sf_dir)
    return LeagueInputs(
        fixtures=lambda: fixtures(t),
        players=lambda: players(t),
        player_gameweeks=lambda: player_gameweeks(t, per_fixture=True),
    )
