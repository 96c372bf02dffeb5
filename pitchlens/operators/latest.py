"""One row (or one value) per key chosen by an order.

Two physical forms, both exact equivalents of ``DISTINCT ON``:

* ``latest_values`` -- one ``max_by`` per output column in a single
  ``groupBy``.  Numeric values with a single numeric order column run as a hash
  aggregate with map-side partial aggregation: whatever the skew of a key, each
  map task sends one row per key through the shuffle.
* ``first_rows`` -- ``row_number() = 1``; Spark adds a group limit before and
  after the shuffle, so again at most one row per key and map task moves.
  Used when whole rows (strings, many columns) are needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _ordering(order: Sequence[ColumnOrName]) -> Column:
    cols = [_col(o) for o in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName],
                  values: Mapping[str, ColumnOrName | tuple[ColumnOrName, ColumnOrName]]) -> DataFrame:
    """D1 + D2 in one aggregation.

    ``values`` maps an output name to a source column (D1: value of the last
    row of the key) or to ``(source, probe)`` (D2: value of the last row of the
    key among rows where ``probe`` is not NULL).  Keys without such a row get
    NULL for that output.
    """
    ordering = _ordering(order)
    aggs = []
    for name, spec in values.items():
        if isinstance(spec, tuple):
            src, probe = spec
            aggs.append(F.max_by(_col(src), F.when(_col(probe).isNotNull(), ordering)).alias(name))
        else:
            aggs.append(F.max_by(_col(spec), ordering).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def first_rows(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """Whole first row per key; ``order`` carries its own direction/nulls."""
    rn = "__pl_rn"
    w = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def latest_per_key(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName]) -> DataFrame:
    """D1 (whole rows): last row per key, ``order`` descending, NULLs last."""
    return first_rows(df, keys, [_col(o).desc_nulls_last() for o in order])


def first_by_tiebreak(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName]) -> DataFrame:
    """D3 (whole rows): first row per key, ``order`` ascending, NULLs last."""
    return first_rows(df, keys, [_col(o).asc_nulls_last() for o in order])


def next_per_key(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[ColumnOrName],
                 where: Column | None = None) -> DataFrame:
    """The next row per key (first by ``order``) among rows matching ``where``."""
    if where is not None:
        df = df.where(where)
    return first_by_tiebreak(df, keys, order)
