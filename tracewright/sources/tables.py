"""Readers for the tool catalog, model responses and exported samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema

RESPONSES = "request_id string, kind string, attempt int, text string"

CATALOG = (
    "version string, tools array<struct<name: string, description: string, category: string, "
    "parameters: array<struct<name: string, type: string, description: string, required: boolean, "
    "enum: array<string>>>, side_effects: boolean>>"
)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog document as rows (version, tool, category, side_effects, param, type, required, enum).

    A tool without parameters is one row with nulls.
    """
    tools = (
        spark.read.schema(CATALOG)
        .option("multiLine", True)
        .json(path)
        .select("version", F.explode("tools").alias("t"))
    )
    return tools.select("version", "t.*").select(
        "version",
        F.col("name").alias("tool"),
        "category",
        "side_effects",
        F.explode_outer("parameters").alias("p"),
    ).select(
        "version",
        "tool",
        "category",
        "side_effects",
        F.col("p.name").alias("param"),
        F.col("p.type").alias("type"),
        F.when(F.col("p").isNotNull(), F.coalesce("p.required", F.lit(True))).alias("required"),
        F.col("p.enum").alias("enum"),
    )


def read_responses(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(RESPONSES).format(file_format).load(path)


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Samples as written by sinks.write_dataset."""
    return spark.read.schema(f"{schema.SAMPLE}, split string").json(path)
