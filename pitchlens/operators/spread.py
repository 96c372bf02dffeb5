"""Windows that don't depend on how many rows a key has.

``Window.partitionBy(key)`` sends every row of a key to one task.  Here the rows
are range-partitioned by (keys, order) instead, so a key with a third of all
rows spans many partitions, and every key takes the same path:

1. Rows are range-partitioned once, tagged with their partition and their place
   in it from both ends, the windows run inside each (partition, key), and the
   result is stored in the shared folder (which also cuts the lineage).
2. Only rows near a partition's ends can have a frame that crosses them.  The
   frame width's rows at both ends of every partition are read back and the
   windows run over them per key: where a partition ends, its last rows and the
   next one's first rows are neighbours.  A running frame needs one more number
   per partition: the total of its first key in the partitions before.
3. These corrections - at most four frame widths of rows per partition, whatever the
   data - are stored and joined to the tagged rows.  Their number is bounded
   by the partition count, which is a setting, so that join is a broadcast.

Two shuffles of the rows (by range, by the range's number), two reads of the input (the
range bounds are sampled), no threshold, no per-key counts.

Bounded frames see the same rows in the same order as one window per key, so
results are identical, doubles too.  Running sums and means of FLOAT / DOUBLE
columns are added in exact limbs (``exactsum.py``): the result is the nearest double of
the exact sum, however the rows are split.

Rows are kept as they are; NULL keys are a key like any other; ties in the order
may come in any order, as in a plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.operators.exactsum import Limbs, limbs_of
from pitchlens.sources.tables import stored_copy

_P, _A, _B, _FIRST = "__pl_part", "__pl_place", "__pl_from_end", "__pl_run_start"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _asc(order) -> list[Column]:
    return [_col(o).asc_nulls_last() for o in order]


def _parts(df: DataFrame, totals) -> list[Limbs | None]:
    """How each aggregate's column is cut into limbs; None where it is added as it is."""
    kinds = [a.col is not None and a.fn != "count" and isinstance(df.select(_col(a.col)).schema[0].dataType, (T.FloatType, T.DoubleType))
             for a in totals]
    cut = iter(limbs_of(df, [_col(a.col) for a, k in zip(totals, kinds, strict=True) if k]) if any(kinds) else ())
    return [next(cut) if k else None for k in kinds]


def running(agg, spec, limbs: Limbs | None) -> tuple[list[Column], Column]:
    """(sums, count) of a running frame that ends 0 or 1 rows before the current one."""
    if agg.frame.start is not None or agg.frame.end not in (0, -1) or agg.fn not in ("sum", "count", "avg"):
        raise ValueError("running frames are sum, count or avg up to lag 1")
    frame = spec.rowsBetween(Window.unboundedPreceding, agg.frame.end)
    target = F.lit(1) if agg.col is None else _col(agg.col)
    inputs = limbs.inputs(target) if limbs else [F.lit(1) if agg.fn == "count" else target]
    return [F.sum(c).over(frame) for c in inputs], F.count(target).over(frame)


def finished(agg, sums: list[Column], n: Column, kind: T.DataType, limbs: Limbs | None) -> Column:
    if agg.fn == "count":
        return n.cast(kind)
    total = limbs.total(sums) if limbs else sums[0]
    return (total if agg.fn == "sum" else F.when(n > 0, total / n)).cast(kind)


def spread_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], aggs: Mapping,
                  seq_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add the ``aggs`` columns (and an optional 1-based sequence number) as one
    window per key would, in ``partitions`` ranges (default: the session's
    shuffle partitions)."""
    from pitchlens.operators.rolling import Agg, Frame, agg_column, result_type  # local: avoid import cycle

    keys = list(keys)
    aggs = dict(aggs)
    bounded = {n: a for n, a in aggs.items() if a.frame.start is not None and a.frame.end is not None}
    totals = {n: a for n, a in aggs.items() if n not in bounded}
    if seq_col:
        totals[seq_col] = Agg("count", None, Frame(None, 0))
    before = max([-a.frame.start for a in bounded.values() if a.frame.start < 0], default=0)
    after = max([a.frame.end for a in bounded.values() if a.frame.end > 0], default=0)
    kinds = {n: result_type(df, a) for n, a in aggs.items()} | ({seq_col: T.LongType()} if seq_col else {})
    limbs = _parts(df, totals.values())
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # 1. windows inside the ranges
    sort = [*_asc(keys), *_asc(order)]
    part = Window.partitionBy(_P)
    own = Window.partitionBy(_P, *keys).orderBy(*_asc(order))
    local = {}
    sums: list[list[str]] = []  # names of each total's sums
    for i, a in enumerate(totals.values()):
        # the frame's, and those of the whole run, for the partitions after: up to and with this row
        for kind, agg in (("", a), ("t", Agg(a.fn, a.col, Frame(None, 0)))):
            values, local[f"__pl_{kind}n{i}"] = running(agg, own, limbs[i])
            local |= {f"__pl_{kind}s{i}_{j}": c for j, c in enumerate(values)}
        sums.append([f"s{i}_{j}" for j in range(len(values))])
    # every range to the task of its number: hashed, several ranges would meet in one task
    tagged = (df.repartitionByRange(n, *sort).withColumn(_P, F.spark_partition_id()).repartitionById(n, _P)
              .withColumns({_A: F.row_number().over(part.orderBy(*sort)), _B: F.count("*").over(part)})
              .withColumn(_B, F.col(_B) - F.col(_A) + 1)
              .withColumns({f"__pl_b_{k}": agg_column(a, own) for k, a in bounded.items()} | local
                           | {_FIRST: F.min(_A).over(Window.partitionBy(_P, *keys))}))
    rows = stored_copy(tagged, "window-rows")

    # 2. the ends of the ranges, as neighbours
    near = max(1, before) + after  # a corrected row also needs the rest of its frame
    ends = rows.where((F.col(_A) <= near) | (F.col(_B) <= near))
    chain = Window.partitionBy(*keys).orderBy(_P, _A)
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    # a key's rows before this partition are the runs that end at the ends of earlier ones
    run = lambda c: F.sum(F.when(F.col(_B) == 1, F.col(c))).over(earlier)
    fixed = {f"__pl_f_{k}": agg_column(a, chain) for k, a in bounded.items()}
    for name in [*(s for own_sums in sums for s in own_sums), *(f"n{i}" for i in range(len(totals)))]:
        fixed[f"__pl_o{name}"] = F.when(F.col(_A) == 1, run(f"__pl_t{name}"))
    fix = (ends.select("*", *[c.alias(k) for k, c in fixed.items()])
           .where((F.col(_A) <= max(1, before)) | (F.col(_B) <= after)).select(_P, _A, *fixed))
    fix = stored_copy(fix, "window-ends")

    # 3. rows with their corrections; at most 2 * near rows per range are broadcast
    r, e, o = rows.alias("r"), F.broadcast(fix).alias("e"), F.broadcast(fix.where(F.col(_A) == 1)).alias("o")
    out = r
    if bounded:
        out = out.join(e, (F.col(f"r.{_P}") == F.col(f"e.{_P}")) & (F.col(f"r.{_A}") == F.col(f"e.{_A}")), "left")
    if totals:
        out = out.join(o, (F.col(f"r.{_P}") == F.col(f"o.{_P}")) & (F.col(f"r.{_FIRST}") == F.col(f"o.{_A}")), "left")
    columns = {}
    for k in bounded:
        columns[k] = F.when(F.col(f"e.{_P}").isNotNull(), F.col(f"e.__pl_f_{k}")).otherwise(F.col(f"r.__pl_b_{k}"))
    for i, (k, a) in enumerate(totals.items()):
        def whole(name: str) -> Column:
            # the sum of run totals has a wider type; cast back, or adding the two would cost a decimal
            x = F.col(f"r.__pl_{name}")
            y = F.col(f"o.__pl_o{name}").cast(rows.schema[f"__pl_{name}"].dataType)
            return F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))

        count = F.coalesce(f"r.__pl_n{i}", F.lit(0)) + F.coalesce(f"o.__pl_on{i}", F.lit(0))
        columns[k] = finished(a, [whole(name) for name in sums[i]], count, kinds[k], limbs[i])
    names = ([seq_col] if seq_col else []) + list(aggs)
    return out.select(*[F.col(f"r.{c}") for c in df.columns], *[columns[k].alias(k) for k in names])
