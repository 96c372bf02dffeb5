"""Seeds, grain checks, and stored / named models."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from pitchlens.session import checkpoint_root
from pitchlens.sources.grain import check_grain  # noqa: F401  S9, with the tables
from pitchlens.sources.published import is_published, publish, version

# The team-mapping seed's column layout.
TEAM_MAPPING_SCHEMA = T.StructType([
    T.StructField("fpl_team_id", T.IntegerType()),
    T.StructField("fpl_name", T.StringType()),
    T.StructField("fpl_short_name", T.StringType()),
    T.StructField("football_data_name", T.StringType()),
    T.StructField("football_data_id", T.IntegerType()),
])


def replace_table(df: DataFrame, path: str, fmt: str = "parquet",
                  partition_by: Sequence[str] = ()) -> None:
    """S6 in place: write the whole table, replacing what was there (no append).  Readers
    see the table missing meanwhile; ``published.publish`` replaces in one step."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def stored_copy(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of the files: a
    lineage cut that survives the loss of any executor."""
    path = f"{checkpoint_root(df.sparkSession)}/pitchlens-{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_seed(spark: SparkSession, path: str, schema: T.StructType = TEAM_MAPPING_SCHEMA) -> DataFrame:
    """CSV with a header row and a fixed schema; malformed rows fail the load."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def register_view(name: str, df: DataFrame) -> DataFrame:
    """A named, unstored model."""
    df.createOrReplaceTempView(name)
    return df


def model_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    return f"{(root or checkpoint_root(spark)).rstrip('/')}/models/{name}"


def full_model(spark: SparkSession, name: str, df: DataFrame, root: str | None = None,
               grain: Sequence[str] = ()) -> DataFrame:
    """Store the model whole as the newest version (the last build stays until then,
    and where ``grain`` is violated) and return the stored table.  The read-back is the
    lineage cut: later models start from files on shared storage, which survive the
    loss of any executor."""
    path = model_path(spark, name, root)
    return publish(spark, path.rsplit("/", 1)[0], {name: df}, {name: grain}).read(spark, name)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table / temp view by name, or a path: a published table's
    (``<root>/<table>``: its newest version) or a parquet folder."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    root, name = name_or_path.rstrip("/").rsplit("/", 1)
    if is_published(spark, root):
        return version(spark, root).read(spark, name)
    return spark.read.parquet(name_or_path)
