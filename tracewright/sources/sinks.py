"""Dataset, review queue and metrics files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def without_private(df: DataFrame) -> DataFrame:
    """Columns whose name starts with an underscore are for internal use and never exported."""
    return df.select([c for c in df.columns if not c.startswith("_")])


def write_dataset(split_samples: DataFrame, path: str) -> None:
    """JSON lines, one folder per split; empty splits have none. Nulls are written out."""
    (
        without_private(split_samples)
        .write.mode("overwrite")
        .partitionBy("split")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def write_review_queue(queue: DataFrame, path: str) -> None:
    queue.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_metrics(counts: DataFrame, path: str) -> None:
    """The one-row funnel."""
    counts.write.mode("overwrite").json(path)
