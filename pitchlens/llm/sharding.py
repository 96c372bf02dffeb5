"""Sharding by fixed virtual slots.

Records hash into a fixed number of virtual slots (thousands); bytes are
aggregated per slot; a versioned slot -> shard map is stored and *edited* when
shards are rebalanced, so records never rehash and only whole slots move.

Version 0 of the map deals the slots round-robin.  The next version keeps, in
every shard, the largest slots up to its fair share of bytes and hands the
freed small slots, largest first, to the least loaded shard.  Everything is
DataFrame expressions; the only data that is brought together is one row per
slot.

Defined cases: a null text counts no bytes (size 1) and has the checksum of
the empty text; null ids hash like any value; equal rows are counted once, dealt
evenly over the slots from their own on (so a record that repeats fills no slot,
and no task, with all its copies) and expanded at the end; an empty table gives no
rows; further columns of the input are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlens.session import checkpoint_root

N_SLOTS = 4096  # virtual slots; fixed for the life of a data set
# share of its fair load that a shard keeps in its own largest slots; the rest
# of its slots are dealt anew and even out what the large ones leave
KEEP = 0.95


def virtual_slot(n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_slots)).cast("int")


def sized_records(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Per distinct record its size and checksum, and the slots its copies are dealt to, a row
    each, with the number of copies there."""
    text = F.coalesce("text", F.lit(""))
    records = (docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"),
                        virtual_slot(n_slots).alias("virtual_slot"))
            .groupBy("doc_id", "size", "text_crc32", "virtual_slot").agg(F.count("*").alias("all")))
    portions = F.least("all", F.lit(n_slots))
    return (records.withColumn("portions", portions)
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("k"))
            .select("doc_id", "size", "text_crc32", F.pmod(F.col("virtual_slot") + F.col("k"), F.lit(n_slots)).cast("int").alias("virtual_slot"),
                    F.expr("all div portions + if(k < all % portions, 1, 0)").alias("copies")))


def slot_loads(records: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes and rows per virtual slot; slots without records have 0."""
    loads = records.groupBy("virtual_slot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"),
                                                F.sum("copies").alias("rows"))
    slots = records.sparkSession.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return (slots.join(loads, "virtual_slot", "left")
            .select("virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.coalesce("rows", F.lit(0)).alias("rows")))


def first_map(loads: DataFrame, n_shards: int) -> DataFrame:
    """Version 0: slots dealt round-robin."""
    return loads.withColumns({"version": F.lit(0), "shard": F.pmod("virtual_slot", F.lit(n_shards)).cast("int")})


def rebalanced(slot_map: DataFrame, n_shards: int, keep: float = KEEP) -> DataFrame:
    """The next version of a map (one row per slot): whole slots move until bytes are near equal."""
    running = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    fair = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / F.lit(n_shards)  # one row per slot
    marked = slot_map.withColumn("kept", F.sum("bytes").over(running) <= fair * keep)
    # one row per slot (n_slots at most) is gathered; all steps below are expressions on arrays
    gathered = marked.agg(
        (F.max("version") + 1).alias("next"),
        F.collect_list(F.when(F.col("kept"), F.struct("virtual_slot", "bytes", "rows", "shard"))).alias("kept"),
        F.sort_array(F.collect_list(F.when(~F.col("kept"), F.struct("bytes", "virtual_slot", "rows"))),
                     asc=False).alias("freed"))
    base = F.transform(F.sequence(F.lit(0), F.lit(n_shards - 1)),
                       lambda s: F.aggregate(F.filter("kept", lambda k: k["shard"] == s), F.lit(0).cast("long"),
                                             lambda a, k: a + k["bytes"]))
    lightest = lambda loads: (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
    state = F.aggregate(
        "freed",
        F.struct(F.col("base").alias("loads"), F.expr("array()").cast("array<int>").alias("to")),
        lambda acc, s: F.struct(
            F.transform(acc["loads"], lambda v, i: F.when(i == lightest(acc["loads"]), v + s["bytes"]).otherwise(v)).alias("loads"),
            F.concat(acc["to"], F.array(lightest(acc["loads"]))).alias("to")))
    moved = F.transform("freed", lambda s, i: F.struct(
        s["virtual_slot"].alias("virtual_slot"), s["bytes"].alias("bytes"), s["rows"].alias("rows"),
        F.element_at(F.col("to"), i + 1).alias("shard")))
    return (gathered.withColumn("base", base).withColumn("to", state["to"])
            .select(F.col("next").alias("version"), F.inline(F.concat("kept", moved)))
            .select("virtual_slot", "bytes", "rows", "version", "shard"))


def stored_map(records: DataFrame, n_shards: int, n_slots: int = N_SLOTS, path: str | None = None) -> tuple[str, int]:
    """Build and store the map's versions under ``path``; returns the path and the last version."""
    spark = records.sparkSession
    path = path or f"{checkpoint_root(spark)}/slot-map-{uuid.uuid4().hex[:12]}"
    first_map(slot_loads(records, n_slots), n_shards).coalesce(1).write.parquet(f"{path}/v0")
    rebalanced(spark.read.parquet(f"{path}/v0"), n_shards).coalesce(1).write.parquet(f"{path}/v1")
    return path, 1


def shard_records(docs: DataFrame, n_shards: int = 8, n_slots: int = N_SLOTS, path: str | None = None) -> DataFrame:
    """Every record with its shard, its place in the shard (gapless from 0), its
    virtual slot and the version of the map that placed it."""
    records = sized_records(docs, n_slots)
    path, version = stored_map(records, n_shards, n_slots, path)
    slot_map = docs.sparkSession.read.parquet(f"{path}/v{version}")
    before = Window.partitionBy("shard").orderBy("virtual_slot")
    places = slot_map.select("virtual_slot", "shard", "version",
                             (F.sum("rows").over(before) - F.col("rows")).alias("slot_start"))
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "size", "text_crc32")
    return (records.withColumn("place", F.sum("copies").over(within) - F.col("copies"))
            .join(F.broadcast(places), "virtual_slot")  # n_slots rows
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("slot_start") + F.col("place") + F.col("copy")).alias("slot"),
                    "virtual_slot", F.col("version").alias("map_version")))
