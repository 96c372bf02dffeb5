"""Build the stored models: the weekly full rebuild, as Spark jobs.

Staging and intermediate models are views (lazy DataFrames).  What several marts
read is stored once by the model graph (``models.py``), so a lost executor costs
a re-read of files.  Marts are written whole and published together: readers see
all marts of the last build or all of this one (S6 / S11), and a mart whose declared
grain is violated refuses the build (S9).
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from pitchlens.plans.league_views import LeagueInputs, league_inputs
from pitchlens.plans.marts import weekly_top_picks
from pitchlens.plans.models import LeagueModels
from pitchlens.session import get_session
from pitchlens.sources.published import publish
from pitchlens.sources.tables import read_table

MARTS = ("player_picks", "fixture_ticker", "backtest_picks")
# unique keys; a double gameweek gives an appearance several rows in backtest_picks
GRAINS = {"player_picks": ["player_id"], "fixture_ticker": ["team_id", "fixture_order"]}


def build(spark: SparkSession, raw: LeagueInputs, out_root: str, season: Sequence[str] = (),
          buckets: int | None = None) -> dict[str, str]:
    """Publish the marts as the next version of ``out_root/marts``; return their paths, for
    ``read_table``.  ``buckets``: store what the player models read by player first."""
    root = f"{out_root.rstrip('/')}/marts"
    m = LeagueModels(raw, season=season, buckets=buckets)
    publish(spark, root, {name: m.model(name) for name in MARTS},
            {name: [*season, *keys] for name, keys in GRAINS.items()})
    return {name: f"{root}/{name}" for name in MARTS}


def top_picks(spark: SparkSession, picks_path: str, k: int = 10) -> DataFrame:
    """M14 on the stored mart: only k rows reach the driver."""
    return weekly_top_picks(read_table(spark, picks_path), k)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Build the league marts from the driver tables.")
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--buckets", type=int, default=None, help="store players and appearances in so many buckets by player")
    args = ap.parse_args(argv)
    spark = get_session(args.master)
    paths = build(spark, league_inputs(spark, args.sf_dir), args.out, buckets=args.buckets)
    top_picks(spark, paths["player_picks"]).show(truncate=False)


if __name__ == "__main__":
    main()
