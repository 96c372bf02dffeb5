"""The saved top-10 picks: score inputs -> scores, cost per point, flags, rank."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.functions import columns as C
from pitchlens.functions import score as S
from pitchlens.plans.marts import NO_POINTS_COST, weekly_top_picks

# (player_id, position, price, points_per_game, form, ownership_pct, transfers_in, transfers_out,
#  net_transfers, next_fdr, opponent_attack, opponent_defense_weakness, opponent_venue_attack,
#  opponent_venue_defense, team_cs_rate, cost_per_point, pick_score, is_differential)
GOLDEN = [
    (449, "MID", 10.3, 6.8, 9.2, 44.2, 91158, 1985, 89173, 2, 0.2, 0.6, 1.0, 1.0, 0.2, 1.5147058823529413, 24.4, False),
    (5, "DEF", 7.2, 6.9, 7.8, 43.2, 51276, 3005, 48271, 3, 0.6, 0.6, 0.6666666666666666, 0.3333333333333333, 0.4, 1.0434782608695652, 23.133333333333336, False),
    (178, "FWD", 6.2, 3.5, 6.0, 4.7, 94095, 1784, 92311, 2, 1.0, 2.0, 1.0, 2.0, 0.4, 1.7714285714285716, 20.0, True),
    (485, "MID", 7.4, 3.9, 7.5, 7.2, 52991, 4825, 48166, 3, 1.4, 1.2, 1.0, 1.0, 0.2, 1.8974358974358976, 20.0, True),
    (8, "DEF", 6.3, 5.0, 6.2, 27.0, 39126, 18270, 20856, 3, 0.6, 0.6, 0.6666666666666666, 0.3333333333333333, 0.4, 1.26, 19.933333333333334, False),
    (386, "MID", 6.3, 2.8, 6.6, 2.5, 6858, 5247, 1611, 2, 1.6, 0.8, 1.0, 1.3333333333333333, 0.2, 2.25, 19.866666666666667, True),
    (6, "DEF", 6.1, 4.3, 5.8, 13.2, 16229, 4903, 11326, 3, 0.6, 0.6, 0.6666666666666666, 0.3333333333333333, 0.4, 1.4186046511627908, 19.133333333333333, False),
    (515, "MID", 7.4, 4.3, 6.0, 4.9, 15395, 5083, 10312, 3, 1.0, 2.0, 0.6666666666666666, 2.0, 0.4, 1.7209302325581397, 19.0, True),
    (329, "MID", 6.1, 5.2, 6.4, 24.9, 40220, 21023, 19197, 4, 1.8, 1.4, 2.3333333333333335, 1.6666666666666667, 0.2, 1.173076923076923, 18.133333333333333, False),
    (169, "MID", 4.9, 3.2, 5.0, 0.4, 7122, 806, 6316, 2, 1.0, 2.0, 1.0, 2.0, 0.4, 1.53125, 18.0, True),
]
COLS = ["player_id", "position", "price", "points_per_game", "form", "ownership_pct", "transfers_in_gw",
        "transfers_out_gw", "net_expected", "next_fdr", "opponent_attack", "opponent_defense_weakness",
        "opponent_venue_attack", "opponent_venue_defense", "team_cs_rate", "cost_expected", "score_expected",
        "flag_expected"]
TYPES = [T.LongType(), T.StringType()] + [T.DoubleType()] * 4 + [T.LongType()] * 3 + [T.LongType()] \
    + [T.DoubleType()] * 5 + [T.DoubleType(), T.DoubleType(), T.BooleanType()]


@pytest.fixture(scope="module")
def scored(spark):
    schema = T.StructType([T.StructField(n, t) for n, t in zip(COLS, TYPES)])
    df = spark.createDataFrame(GOLDEN, schema)
    x = S.ScoreInputs(
        position=F.col("position"), form=F.col("form"), fdr=F.col("next_fdr"),
        opp_defense=S.opponent_stat(F.col("opponent_venue_defense"), F.col("opponent_defense_weakness")),
        opp_attack=S.opponent_stat(F.col("opponent_venue_attack"), F.col("opponent_attack")),
        clean_sheet=F.col("team_cs_rate"))
    return df.select(
        "*",
        S.live_pick_score(x).alias("pick_score"),
        C.ratio_or("price", "points_per_game", NO_POINTS_COST).alias("cost_per_point"),
        C.difference("transfers_in_gw", "transfers_out_gw").alias("net_transfers"),
        S.is_differential(F.col("form"), F.col("ownership_pct")).alias("is_differential"),
    )


def test_golden_scores(scored):
    for r in scored.collect():
        assert r.pick_score == pytest.approx(r.score_expected, abs=1e-9), r.player_id
        assert r.cost_per_point == pytest.approx(r.cost_expected, abs=1e-9), r.player_id
        assert r.net_transfers == r.net_expected
        assert r.is_differential == r.flag_expected


def test_golden_rank_order(scored):
    top = [r.player_id for r in weekly_top_picks(scored).collect()]
    # rows 3 and 4 tie on 20.0; the lower id comes first
    assert top == [g[0] for g in GOLDEN]
