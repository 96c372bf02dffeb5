"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants.  Partition counts are left to
# the caller (a cluster sets them for its data size; tests pass a small value).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # large clusters: set shuffle partitions high and let AQE coalesce to
    # partitions of about this size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "pitchlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED = "_pitchlens_sources_shipped"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context, so that it needn't be
    installed on the executors (as ``spark-submit --py-files`` does)."""
    sc = spark.sparkContext
    if not getattr(sc, _SHIPPED, False):
        top = os.path.dirname(os.path.abspath(__file__))
        into = os.path.join(tempfile.mkdtemp(prefix="pitchlens-sources-"), "pitchlens-sources")
        sc.addPyFile(shutil.make_archive(into, "zip", os.path.dirname(top), os.path.basename(top)))
        setattr(sc, _SHIPPED, True)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and materialised models.

    A cluster names it in ``spark.checkpoint.dir``; that value is always used.
    Only in local mode, when neither the setting nor a context checkpoint
    folder exists (local runs, tests), a private folder is created and
    registered with the context, so that every later caller sees the same
    one.  On a cluster without the setting this is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return os.path.dirname(existing.rstrip("/"))
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder would not survive the loss of an executor
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="pitchlens-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root
