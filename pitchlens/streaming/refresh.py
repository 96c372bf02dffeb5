"""Incremental landing of payload files with full-replace sinks.

The reference refreshes weekly: a new payload is fetched and every raw table
is replaced.  As a Structured Streaming job this is a file source over the
landing folder and a ``foreachBatch`` sink.  A load is a folder of files
(``<landing>/<load>/*.json``; files directly in the landing folder are one load):
each micro-batch holds the newly landed documents, the newest load wins with all
its files (a backlog of several weeks replaces the tables once), its record arrays
are exploded (S1) and all tables are published as one version (S6): a document that
doesn't parse stops the batch and leaves every table alone, and readers never see
tables of two loads.  The version notes the stream's batch, so a batch that is run
again after a crash is published once.  The checkpoint (offsets of files already
processed) lives under the cluster's shared checkpoint folder, so a restarted job
resumes without reloading old files.

Run it on a schedule with ``trigger(availableNow=True)``: it processes what
has landed and stops.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pitchlens.session import checkpoint_root
from pitchlens.sources.landing import explode_payload
from pitchlens.sources.published import publish, read_text

_MTIME, _LOAD = "__pl_mtime", "__pl_load"


def latest_load(batch: DataFrame) -> DataFrame:
    """All documents of the newest load in the batch (by its last modification time, then name)."""
    newest = batch.select(F.max(F.struct(_MTIME, _LOAD)).getField(_LOAD)).scalar()
    return batch.where(F.col(_LOAD) == newest)


def replace_tables_from_payload(batch: DataFrame, tables: Mapping[str, str], out_root: str,
                                stream: tuple[str, int] | None = None,
                                grains: Mapping[str, Sequence[str]] | None = None) -> None:
    """``tables`` maps an array field of the document to a table name; ``stream`` is the
    stream's name and the number of its batch; ``grains`` are unique keys per table."""
    doc = latest_load(batch)
    doc = doc.select(F.struct(*[c for c in doc.columns if not c.startswith("__pl_")]).alias("doc"))
    publish(batch.sparkSession, out_root, {table: explode_payload(doc, field) for field, table in tables.items()},
            grains, stream)


def start_refresh(spark: SparkSession, landing_dir: str, doc_schema: T.StructType,
                  tables: Mapping[str, str], out_root: str, name: str = "bootstrap",
                  available_now: bool = True,
                  grains: Mapping[str, Sequence[str]] | None = None) -> StreamingQuery:
    stream = (spark.readStream.schema(doc_schema).option("multiLine", True).option("mode", "FAILFAST")
              .option("recursiveFileLookup", True).json(landing_dir)
              .select("*", F.col("_metadata.file_modification_time").alias(_MTIME),
                      F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias(_LOAD)))
    checkpoint = f"{checkpoint_root(spark).rstrip('/')}/streams/{name}"

    def sink(batch: DataFrame, epoch: int) -> None:
        if not batch.isEmpty():
            # the id is the checkpoint's: a stream begun anew counts its batches anew
            own = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
            replace_tables_from_payload(batch, tables, out_root, (own, epoch), grains)

    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
    return writer.start()
