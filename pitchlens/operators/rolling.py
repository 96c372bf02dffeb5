"""Trailing, lagged, cumulative and look-ahead windows over keyed,
ordered rows, plus sequence numbers.

Frames always count ROWS (a blank period does not shorten a window).  All
aggregates that share keys and order go into one ``select``, so Catalyst plans
a single Window node: one shuffle on the keys and one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from pitchlens.operators.spread import spread_window

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Frame:
    """ROWS frame relative to the current row; ``None`` means unbounded."""

    start: int | None
    end: int | None


def trailing(n: int, lag: int = 0) -> Frame:
    """Last ``n`` rows ending ``lag`` rows before the current one.

    lag=0: ``n-1 PRECEDING .. CURRENT ROW``; lag=1: ``n PRECEDING .. 1 PRECEDING``
    (point-in-time values for backtests: the current row never leaks in).
    """
    return Frame(-(n - 1) - lag, -lag)


def cumulative(lag: int = 0) -> Frame:
    """``UNBOUNDED PRECEDING .. lag PRECEDING``."""
    return Frame(None, -lag)


def ahead(n: int) -> Frame:
    """``CURRENT ROW .. n-1 FOLLOWING``; shrinks at the end of a key."""
    return Frame(0, n - 1)


@dataclass(frozen=True)
class Agg:
    """A window aggregate: ``fn`` over ``col`` in ``frame``."""

    fn: str  # "avg" | "sum" | "count"
    col: ColumnOrName | None
    frame: Frame


_FUNCS = {
    "avg": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
}


def order_columns(order: Sequence[ColumnOrName]) -> list[Column]:
    """Ascending, NULLs last (the reference engine's default)."""
    return [_col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def window(keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName]) -> WindowSpec:
    return Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order_columns(order))


def _bound(v: int | None, unbounded: int) -> int:
    return unbounded if v is None else v


def agg_column(agg: Agg, spec: WindowSpec) -> Column:
    framed = spec.rowsBetween(_bound(agg.frame.start, Window.unboundedPreceding),
                              _bound(agg.frame.end, Window.unboundedFollowing))
    if agg.fn == "count":
        target = F.lit(1) if agg.col is None else _col(agg.col)
        return F.count(target).over(framed)
    return _FUNCS[agg.fn](_col(agg.col)).over(framed)


def result_type(df: DataFrame, agg: Agg) -> DataType:
    """The type of an aggregate's output column."""
    return df.select(agg_column(agg, Window.partitionBy(F.lit(0)).orderBy(F.lit(0)))).schema[0].dataType


def rolling(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName],
            aggs: Mapping[str, Agg], spread: bool = False) -> DataFrame:
    """Add one column per ``Agg``; all share ``keys`` and ``order``.

    ``order`` must be a total order within a key (add tie-break columns), or
    the rows a frame sees are not deterministic.  By default a key's rows are
    one window partition: for keys whose rows are bounded by their meaning (a
    team's matches of a season).  ``spread=True`` is for keys that may hold any
    share of the rows: all keys then take the range-partitioned path of
    ``spread.py``.
    """
    if spread:
        return spread_window(df, keys, order, aggs)
    spec = window(keys, order)
    return df.withColumns({name: agg_column(agg, spec) for name, agg in aggs.items()})


def rolling_by_subgroup(df: DataFrame, keys: Sequence[ColumnOrName], sub_col: str,
                        order: Sequence[ColumnOrName],
                        aggs: Mapping[str, tuple[str, Agg]], spread: bool = False) -> DataFrame:
    """Windows over the rows of one subgroup, attached only to its rows.

    ``aggs`` is ``{out: (sub_value, Agg)}``: ``out`` is computed over the rows of
    the key whose ``sub_col`` equals ``sub_value`` and is NULL on other rows.
    This is the join of a filtered, windowed copy back onto the full rows,
    done as one window over ``keys + [sub_col]`` (no self-join, no extra scan).
    """
    out = rolling(df, [*keys, sub_col], order, {n: a for n, (_, a) in aggs.items()}, spread=spread)
    return out.withColumns({
        name: F.when(F.col(sub_col) == F.lit(value), F.col(name)) for name, (value, _) in aggs.items()
    })


def sequence_number(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName],
                    out: str = "seq", aggs: Mapping[str, Agg] | None = None,
                    spread: bool = False) -> DataFrame:
    """1, 2, 3 ... per key in order, as BIGINT, plus optional window
    aggregates over the same order (one window, one sort)."""
    aggs = dict(aggs or {})
    if spread:
        return spread_window(df, keys, order, aggs, seq_col=out)
    spec = window(keys, order)
    return df.withColumns({out: F.row_number().over(spec).cast("bigint"),
                           **{n: agg_column(a, spec) for n, a in aggs.items()}})


def first_n_with_ahead(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName],
                       n: int, seq_col: str = "seq", aggs: Mapping[str, Agg] | None = None) -> DataFrame:
    """F7 after W10: the first ``n`` rows per key, numbered, with look-ahead
    (or trailing) aggregates computed over the full ordered rows.

    Row ``n`` needs the ``w`` rows after it, so rows are first cut at
    ``n + w`` with ``row_number``: Spark turns that cut into a group limit
    on both sides of the shuffle, so at most ``n + w`` rows per key and map
    task are exchanged -- however many rows a key has.  The aggregates then
    run over the cut rows with the same partitioning and order (no second
    shuffle or sort), and the result is cut at ``n``.  Exact: no aggregate of
    a kept row reads past row ``n + w``.
    """
    aggs = dict(aggs or {})
    for name, a in aggs.items():
        if a.frame.end is None:
            raise ValueError(f"{name}: unbounded-following frames cannot be cut")
    width = max([a.frame.end for a in aggs.values() if a.frame.end > 0], default=0)
    spec = window(keys, order)
    head = df.withColumn(seq_col, F.row_number().over(spec).cast("bigint")).where(
        F.col(seq_col) <= F.lit(n + width))
    return head.withColumns({name: agg_column(a, spec) for name, a in aggs.items()}).where(
        F.col(seq_col) <= F.lit(n))
