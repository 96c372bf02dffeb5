"""Position-aware pick scores.

A score is a weighted sum of terms, with weights kept in a table per position:

  form         form rating
  ease         FDR_CEILING - fixture difficulty
  opp_defense  opponent's defensive weakness (goals conceded per match)
  opp_attack   ATTACK_PIVOT - opponent's attack (goals scored per match)
  clean_sheet  own team's clean-sheet rate

Terms are added in the order above, left to right, so the floating-point
result does not depend on the engine.  Positions missing from the table (and
a NULL position) score NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pick-score weights per position and the two pivots.
PICK_WEIGHTS: dict[str, dict[str, float]] = {
    "FWD": {"form": 2.0, "ease": 1.0, "opp_defense": 2.0},
    "MID": {"form": 2.0, "ease": 1.0, "opp_defense": 2.0},
    "DEF": {"form": 2.0, "ease": 1.0, "opp_attack": 2.5, "clean_sheet": 3.0},
    "GK": {"form": 2.0, "ease": 1.0, "opp_attack": 3.0, "clean_sheet": 4.0},
}
FDR_CEILING = 6.0
ATTACK_PIVOT = 2.0
OPPONENT_FALLBACK = 1.0
# Differential flag thresholds (form at least, ownership below).
DIFFERENTIAL_MIN_FORM = 5.0
DIFFERENTIAL_MAX_OWNERSHIP = 10.0

_TERM_ORDER = ("form", "ease", "opp_defense", "opp_attack", "clean_sheet")


@dataclass(frozen=True)
class ScoreInputs:
    position: Column
    form: Column
    fdr: Column
    opp_defense: Column   # already resolved: venue stat, else blended, else fallback
    opp_attack: Column
    clean_sheet: Column


def _terms(x: ScoreInputs) -> dict[str, Column]:
    return {
        "form": x.form,
        "ease": F.lit(FDR_CEILING) - x.fdr,
        "opp_defense": x.opp_defense,
        "opp_attack": F.lit(ATTACK_PIVOT) - x.opp_attack,
        "clean_sheet": x.clean_sheet,
    }


def weighted(x: ScoreInputs, weights: Mapping[str, float]) -> Column:
    terms = _terms(x)
    total = None
    for name in _TERM_ORDER:
        if name in weights:
            part = terms[name] * F.lit(float(weights[name]))
            total = part if total is None else total + part
    return total


def by_position(x: ScoreInputs, weights: Mapping[str, Mapping[str, float]], start: Column) -> Column:
    """Extend a ``when`` chain with one branch per distinct weight set."""
    expr = start
    grouped: dict[tuple, list[str]] = {}
    for pos, w in weights.items():
        grouped.setdefault(tuple(sorted(w.items())), []).append(pos)
    for key, positions in grouped.items():
        cond = x.position.isin(positions) if len(positions) > 1 else x.position == F.lit(positions[0])
        expr = expr.when(cond, weighted(x, dict(key)))
    return expr


def live_pick_score(x: ScoreInputs, weights: Mapping[str, Mapping[str, float]] = PICK_WEIGHTS) -> Column:
    """P20: zero form or unknown next difficulty scores 0.0; a NULL clean-sheet
    rate makes a DEF/GK score NULL."""
    start = F.when((x.form == F.lit(0)) | x.fdr.isNull(), F.lit(0.0))
    return by_position(x, weights, start)


def lagged_pick_score(x: ScoreInputs, weights: Mapping[str, Mapping[str, float]] = PICK_WEIGHTS) -> Column:
    """Unknown form or difficulty scores NULL; a zero form is scored.

    The caller passes ``clean_sheet`` with NULL already replaced by 0.0.
    """
    start = F.when(x.form.isNull() | x.fdr.isNull(), F.lit(None).cast("double"))
    return by_position(x, weights, start)


def opponent_stat(venue_stat: Column, blended_stat: Column) -> Column:
    """Venue-specific stat, else blended, else the neutral fallback."""
    return F.coalesce(venue_stat, blended_stat, F.lit(OPPONENT_FALLBACK))


def is_differential(form: Column, ownership: Column) -> Column:
    """In form and owned by few; NULLs count as false."""
    cond = (form >= F.lit(DIFFERENTIAL_MIN_FORM)) & (ownership < F.lit(DIFFERENTIAL_MAX_OWNERSHIP))
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))
