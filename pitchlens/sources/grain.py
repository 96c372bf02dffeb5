"""A table's grain, the keys that are unique in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_grain(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Rows of ``keys`` that occur more than once (empty when the grain holds).

    A plain aggregation: partial counts are combined map-side, so a hot key
    costs one row per map task in the shuffle.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > F.lit(1)))
