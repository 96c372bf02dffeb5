"""A left join whose match is also conditioned on the left row itself."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_where(left: DataFrame, right: DataFrame, on: Sequence[str], left_pred: Column,
                    columns: Sequence[str]) -> DataFrame:
    """Every left row, with ``columns`` of the right rows of equal ``on`` keys where
    ``left_pred`` (over the left columns) is true, and NULL elsewhere.

    The predicate decides what matches, not what stays: as a filter it would drop
    rows.  It is part of the join's condition, so all rows are dealt by their own keys
    (nulling the keys of rows that can't match would send these to one task).  Rows
    whose predicate is NULL match nothing; a right key that occurs twice gives two rows.
    """
    match = "__pl_match"
    keys = reduce(and_, (F.col(f"l.{k}") == F.col(f"r.{k}") for k in on))
    joined = left.withColumn(match, left_pred).alias("l").join(right.select(*on, *columns).alias("r"), keys & F.col(f"l.{match}"), "left")
    return joined.select(*[F.col(f"l.`{c}`") for c in left.columns], *[F.col(f"r.{c}") for c in columns])
