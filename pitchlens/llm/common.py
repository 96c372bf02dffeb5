"""Helpers the operators share: table access, stored intermediates, Arrow batches."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlens.session import checkpoint_root

# Rows per Arrow batch sent to Python workers.  A batch holds whole texts, so
# a few hundred rows keep a worker's memory at a few times the longest text.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of the files.

    The lineage is cut there: a lost executor costs a re-read, never a
    recomputation of the steps before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED = "_pitchlens_package_shipped"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark context, so that it
    needn't be installed on the executors (as ``spark-submit --py-files`` does)."""
    sc = spark.sparkContext
    if not getattr(sc, _SHIPPED, False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        into = os.path.join(tempfile.mkdtemp(prefix="pitchlens-package-"), "pitchlens-package")
        sc.addPyFile(shutil.make_archive(into, "zip", os.path.dirname(top), os.path.basename(top)))
        setattr(sc, _SHIPPED, True)


def map_batches(
    df: DataFrame,
    fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    """``mapInArrow`` with batches small enough for whole texts.

    Lowers ``spark.sql.execution.arrow.maxRecordsPerBatch`` of the session
    where it is larger: the plan reads it when it runs.
    """
    ship_package(df.sparkSession)
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > batch_rows:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    return df.mapInArrow(fn, schema)


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A row's identity: its id, where ids repeat also its text.  Rows equal in
    both are copies of one another and share every result."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
