"""One row per event -> one row per participating side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sides(df: DataFrame, per_side: Sequence[tuple[str, Mapping[str, ColumnOrName]]],
          tag_col: str = "venue", keep: Sequence[ColumnOrName] = ()) -> DataFrame:
    """Emit one row per side of every input row.

    ``per_side`` is ``[(tag, {out_col: source}), ...]``; every side must map the
    same output names (in the same order) to sources of the same type.  The
    rows are produced by one generator over a single scan of ``df`` (an
    ``inline`` of an array of structs), instead of a UNION ALL that scans the
    input once per side.
    """
    names = list(per_side[0][1])
    for tag_value, mapping in per_side:
        if list(mapping) != names:
            raise ValueError(f"side {tag_value!r} maps {list(mapping)}, expected {names}")
    structs = [
        F.struct(*[_col(mapping[n]).alias(n) for n in names], F.lit(tag_value).alias(tag_col))
        for tag_value, mapping in per_side
    ]
    return df.select(*[_col(k) for k in keep], F.inline(F.array(*structs)))


def two_sided(df: DataFrame, home: Mapping[str, ColumnOrName], away: Mapping[str, ColumnOrName],
              tag_col: str = "venue", tags: tuple[str, str] = ("home", "away"),
              keep: Sequence[ColumnOrName] = ()) -> DataFrame:
    """Two rows per match: the home side's view and the away side's view."""
    return sides(df, [(tags[0], home), (tags[1], away)], tag_col=tag_col, keep=keep)
