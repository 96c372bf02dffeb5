"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. quality rules: documents the learned decision list rejects go;
2. near duplicates: one document of each class stays;
3. benchmark decontamination: passages of the benchmark are cut out;
4. personal data: spans are replaced by their kind;
5. subword encoding: token ids per document, verified by decoding.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitchlens.llm import decontam, encode, neardup, pii, quality
from pitchlens.llm.common import table
from pitchlens.session import checkpoint_root


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def subword_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode.encoded(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("subword encoding", subword_encoding),
]

#: learned rules, sampled candidates and learned patterns aren't SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; intermediates go to the shared folder."""
    root = f"{checkpoint_root(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return docs
