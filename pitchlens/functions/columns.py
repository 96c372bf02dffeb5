"""Column expressions used by the models.

Every helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside whole-stage codegen; none of them touches rows in Python.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_label(code: ColumnOrName, labels: Mapping[object, str]) -> Column:
    """Map codes to labels; an unknown or NULL code gives NULL."""
    code = _col(code)
    expr = None
    for key, label in labels.items():
        expr = (F.when(code == F.lit(key), F.lit(label)) if expr is None
                else expr.when(code == F.lit(key), F.lit(label)))
    return expr if expr is not None else F.lit(None).cast("string")



def text_number(c: ColumnOrName, default: str = "0") -> Column:
    """Numeric text -> DOUBLE, NULL -> default.

    Malformed text (the empty string too) raises under ANSI mode, as it does
    in the reference engine; it is never silently turned into NULL.
    """
    return F.coalesce(_col(c), F.lit(default)).cast("double")


def scaled(c: ColumnOrName, factor: float = 10.0) -> Column:
    """P5: fixed-point value (e.g. price in tenths) -> units, as DOUBLE."""
    return _col(c).cast("double") / F.lit(float(factor))


def outcome_from_scores(finished: ColumnOrName, home: ColumnOrName, away: ColumnOrName) -> Column:
    """Unfinished -> scheduled; else home_win / away_win / draw.

    A finished match without scores (and a NULL ``finished`` without scores)
    gives NULL: the branches are tried in order and no ELSE is given.
    """
    finished, home, away = _col(finished), _col(home), _col(away)
    return (F.when(finished == F.lit(False), F.lit("scheduled"))
            .when(home > away, F.lit("home_win"))
            .when(away > home, F.lit("away_win"))
            .when(home == away, F.lit("draw")))


# Winner codes of the match feed and the outcome labels they map to.
WINNER_LABELS = {"HOME_TEAM": "home_win", "AWAY_TEAM": "away_win", "DRAW": "draw"}


def outcome_from_winner(winner: ColumnOrName) -> Column:
    """Winner code -> outcome; anything else, NULL included -> scheduled."""
    winner = _col(winner)
    expr = None
    for code, label in WINNER_LABELS.items():
        expr = (F.when(winner == F.lit(code), F.lit(label)) if expr is None
                else expr.when(winner == F.lit(code), F.lit(label)))
    return expr.otherwise(F.lit("scheduled"))


def parsed_json(c: ColumnOrName, schema: DataType) -> Column:
    """JSON text by a declared schema; text that isn't such a document raises
    (blank text too), a NULL document gives NULL."""
    c = _col(c)
    doc = F.from_json(c, schema, {"mode": "FAILFAST"})
    return F.when(c.isNotNull() & (F.trim(c) == F.lit("")), F.raise_error(F.lit("blank JSON document"))).otherwise(doc)


def checked_json(c: ColumnOrName) -> Column:
    """The text itself where it parses as JSON; raises where it doesn't."""
    c = _col(c)
    # the parser gives no variant for text that isn't JSON
    return (F.when(c.isNull() | F.try_parse_json(c).isNotNull(), c)
            .otherwise(F.raise_error(F.concat(F.lit("malformed JSON: "), F.substring(c, 1, 80)))))


def json_text(c: ColumnOrName, path: str) -> Column:
    """JSON path -> text; JSON null and a NULL document give NULL, a malformed
    document raises."""
    return F.get_json_object(checked_json(c), path)


def json_int(c: ColumnOrName, path: str) -> Column:
    """JSON path -> INT (malformed numbers raise under ANSI)."""
    return json_text(c, path).cast("int")


def difference(a: ColumnOrName, b: ColumnOrName) -> Column:
    """P10."""
    return _col(a) - _col(b)


def ratio_or(num: ColumnOrName, den: ColumnOrName, default: float) -> Column:
    """Num / den when den > 0, else a sentinel (never divides by zero)."""
    den = _col(den)
    return F.when(den > F.lit(0), _col(num) / den).otherwise(F.lit(float(default)))


def ratio_or_null(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den as DOUBLE when den > 0, else NULL."""
    den = _col(den)
    return F.when(den > F.lit(0), _col(num).cast("double") / den)


def bucket_label(c: ColumnOrName, easy_max: int = 2, medium: int = 3, hard_min: int = 4) -> Column:
    """<= easy_max easy, == medium medium, >= hard_min hard, else NULL."""
    c = _col(c)
    return (F.when(c <= F.lit(easy_max), F.lit("easy"))
            .when(c == F.lit(medium), F.lit("medium"))
            .when(c >= F.lit(hard_min), F.lit("hard")))




def venue_switch(venue: ColumnOrName, when_home: ColumnOrName, when_away: ColumnOrName,
                 home: str = "home", away: str = "away") -> Column:
    """Pick a column by venue; any other venue gives NULL."""
    venue = _col(venue)
    return (F.when(venue == F.lit(home), _col(when_home))
            .when(venue == F.lit(away), _col(when_away)))


def result_points(result: ColumnOrName, win_label: str, draw_label: str = "draw",
                  win: int = 3, draw: int = 1) -> Column:
    """Points from the perspective of one side; NULL result -> 0."""
    result = _col(result)
    return (F.when(result == F.lit(win_label), F.lit(win))
            .when(result == F.lit(draw_label), F.lit(draw))
            .otherwise(F.lit(0)))


def indicator(cond: Column) -> Column:
    """1.0 / 0.0 as DOUBLE (a DECIMAL average would lose digits)."""
    return F.when(cond, F.lit(1.0)).otherwise(F.lit(0.0))
