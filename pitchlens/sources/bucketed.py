"""Tables stored by key, so that windows and joins on the key read them without a shuffle.

A table's rows are hashed by its keys into a fixed number of buckets, one file each,
sorted by the keys and an order inside.  Spark reads such a table as already
partitioned by the keys: a join of two tables of the same keys and number, a window or
an aggregation by them plan no exchange.  The shuffle is paid once, when the table is
stored, and not by every model and build that reads it.

Take about one bucket per 128 MB of the table at its full size: a bucket is read by one
task.  A key whose rows are not bounded by their meaning would make its bucket grow
with it; such tables stay unbucketed and use the range-partitioned windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from pitchlens.session import checkpoint_root


def stored_by_key(df: DataFrame, tag: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int = 64,
                  root: str | None = None) -> DataFrame:
    """Store ``df`` in ``buckets`` buckets by ``keys``, sorted by keys and ``order``, and return
    the stored table.

    The files go to ``root`` (the shared folder by default); the layout is known to
    the session's catalog under a name of its own.
    """
    spark = df.sparkSession
    name = f"pitchlens_{tag.replace('-', '_')}_{uuid.uuid4().hex[:12]}"
    path = f"{(root or checkpoint_root(spark)).rstrip('/')}/{name}"
    # the exchange's hash is the buckets' hash: every task writes one file
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name))
    return spark.table(name)
