"""A Merkle manifest of a table, by nested-struct rollup.

A row's *leaf* is the SHA-256 of its fields.  Per group (a tree), leaves in order;
while several nodes remain, every ``FAN`` consecutive ones become the SHA-256 of
their digests.  What remains is the group's root; the groups' roots, in the order
of the groups (null first, by bytes), become the table's root in the same way.

1. Leaves are expressions of the scanned row; only digests move after that.
2. Ranks come from a range partitioning by (group, order) and the sizes of the ranges
   (``sequence_number(spread=True)``), so no group is sorted in one task.
3. *Rollup.*  A rank is written in base ``FAN``.  Its lowest ``DIGITS`` digits are its
   place in a block of ``FAN ** DIGITS`` rows, and rows are shuffled once, by block.
   Grouping by all digits but the lowest nests ``FAN`` children in their parent's
   struct, grouping by all but the two lowest nests the parents, and so on: successive
   aggregations of one partitioning, until a block is one row that holds its part of
   the tree.  The blocks' digests are the rows of the next round, N / 512 of them, and
   rounds go on until a tree has one node.  Nothing larger than a block is ever one row.
4. *Proofs.*  From the top round down, the path above a block is grouped to the block's
   row by its number; then a ``transform`` gives each child its left and right siblings
   and an ``explode`` opens the children, level by level.  No join.

Defined cases: a null field is ``-`` in the leaf; a null group is a tree of its own, the
first; rows without an order value come last in their group; rows that repeat are leaves
of their own, next to each other (ties in the order are in the order of their leaves); a
lone leaf is its group's root, a lone group's root the table's; an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import stored
from pitchlens.operators.rolling import sequence_number

FAN = 8
DIGITS = 3  # levels of a block, which has FAN ** DIGITS rows
BLOCK = FAN ** DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def leaf(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its bytes' number, a colon and its text."""
    parts = [F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")))
             for c in fields]
    return F.sha2(F.concat(*parts), 256)


def _digests(kids: Column) -> Column:
    return F.array_join(F.transform(kids, lambda kid: kid.hash), "")


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block: tree, n, block, hash and kids, the nested structs of its part of the
    tree.  ``nodes``: tree, n (nodes of the tree), rank (from 0), hash and own, carried."""
    digits = [f"d{k}" for k in range(DIGITS)]
    rows = nodes.select("tree", "n", F.expr(f"rank div {BLOCK}").alias("block"), F.struct("hash", F.col("own").alias("kids")).alias("node"),
                        *[F.expr(f"cast(rank div {FAN ** k} % {FAN} as int)").alias(d) for k, d in enumerate(digits)])
    rows = rows.repartition("tree", "block")
    for k, digit in enumerate(digits):
        nested = rows.groupBy("tree", "n", "block", *digits[k + 1:]).agg(F.sort_array(F.collect_list(F.struct(digit, "node"))).alias("kids"))
        nested = nested.withColumn("kids", F.transform("kids", lambda x: x.node))
        # nodes of this level, of which a lone one moves up as it is
        hashed = F.when(F.col("n") > FAN ** k, F.sha2(_digests(F.col("kids")), 256)).otherwise(F.col("kids")[0].hash)
        rows = nested.withColumn("node", F.struct(hashed.alias("hash"), "kids"))
    return rows.select("tree", "n", "block", "node.hash", "node.kids")


def _climbed(nodes: DataFrame, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds' blocks, stored, and what remains per tree: (tree, hash)."""
    rounds: list[DataFrame] = []
    while True:
        rounds.append(stored(_blocks(nodes), f"merkle-{tag}"))
        above = rounds[-1].select("tree", F.ceil(F.col("n") / BLOCK).alias("n"), F.col("block").alias("rank"), "hash", F.struct("block").alias("own"))
        if above.where("n > 1").isEmpty():
            return rounds, above.select("tree", "hash")
        nodes = above


def _opened(blocks: DataFrame, paths: DataFrame | None) -> DataFrame:
    """tree, hash, own and path (siblings, bottom up) of a round's nodes, with the carried
    ``top`` of the path's row; ``paths``: tree, block, path, top."""
    if paths is None:
        rows = blocks.select("tree", "n", "kids", F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("top"))
    else:
        both = blocks.select("tree", "block", "n", "kids").unionByName(paths.select("tree", "block", "path", "top"), allowMissingColumns=True)
        rows = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "path", "top")])
    for k in reversed(range(DIGITS)):
        def siblings(kid: Column, at: Column) -> Column:
            left, right = F.slice("kids", F.lit(1), at), F.slice("kids", at + 2, F.lit(FAN))
            return F.struct(kid.alias("kid"), _digests(left).alias("left"), _digests(right).alias("right"))

        rows = rows.select("tree", "n", "path", "top", F.explode(F.transform("kids", siblings)).alias("at"))
        step = F.array(F.struct("at.left", "at.right")).cast(_PATH)
        # a lone node has moved up as it was
        path = F.when(F.col("n") > FAN ** k, F.concat(step, "path")).otherwise(F.col("path"))
        rows = rows.select("tree", "n", "top", path.alias("path"), "at.kid.hash", "at.kid.kids")
    return rows.select("tree", "hash", F.col("kids").alias("own"), "path", "top")


def _ranked(nodes: DataFrame, order: Sequence[str], one_tree: bool = False) -> DataFrame:
    """``nodes`` with rank (from 0, in its tree) and n (nodes of the tree)."""
    ranked = sequence_number(nodes, ["tree"], order, "rank", spread=True).withColumn("rank", F.col("rank") - 1)
    if one_tree:
        return ranked.withColumn("n", nodes.select(F.count("*")).scalar())
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("n")).withColumnRenamed("tree", "of")
    return ranked.join(sizes, F.col("tree").eqNullSafe(F.col("of"))).drop("of")


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
             carry: Mapping[str, Column] | None = None) -> DataFrame:
    """Per row: the ``order`` column, leaf, path (left and right siblings, level by level up to
    the table's root), subroot, root, and ``carry``, columns computed from the row."""
    carry = carry or {}
    leaves = docs.select(
        F.col(group).cast("string").alias("tree"), leaf([F.col(f"`{c}`") for c in fields]).alias("hash"),
        F.col(order).alias("at"), F.struct(F.col(order).alias("at"), *[c.alias(name) for name, c in carry.items()]).alias("own"))
    rounds, subroots = _climbed(_ranked(leaves, ["at", "hash"]).drop("at"), "leaves")

    groups = stored(subroots, "merkle-subroots").select(
        F.lit("").alias("tree"), "hash", F.col("tree").isNotNull().alias("named"), F.col("tree").alias("name"),
        F.struct(F.col("tree").alias("name")).alias("own"))
    above, top = _climbed(_ranked(groups, ["named", "name"], one_tree=True).drop("named", "name"), "groups")
    root = next((r["hash"] for r in top.take(1)), None)

    paths = None
    for k in reversed(range(len(above))):
        paths = _opened(above[k], paths)
        paths = paths.select("tree", F.col("own.block").alias("block"), "path", "top") if k else paths
    paths = paths.select(F.col("own.name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("hash").alias("top"))
    for k in reversed(range(len(rounds))):
        paths = _opened(rounds[k], paths)
        paths = paths.select("tree", F.col("own.block").alias("block"), "path", "top") if k else paths
    return paths.select(F.col("own.at").alias(order), F.col("hash").alias("leaf"), "path", F.col("top").alias("subroot"),
                        F.lit(root).cast("string").alias("root"), *[F.col(f"own.`{name}`").alias(name) for name in carry])


def proof(path: Column) -> Column:
    """The siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), "")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(step.left, h, step.right), 256))
