"""From raw documents to token ids: five stages, each on what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracewright.llm import stages
from tracewright.session import materialize

STAGES = [
    ("quality_rules", stages.quality_rules_stage),
    ("near_dedup", stages.near_dedup_stage),
    ("pii", stages.pii_stage),
    ("mixing", stages.mixing_stage),
    ("bpe", stages.bpe_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over `documents`, each one's rows written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
